"""Folders of Parquet files that keep their rows by key between jobs.

A row goes to the bucket of its key's hash, and each bucket is a file of its own (in a
partitioned folder one for each partition). What groups or joins by the key reads the
buckets as they are, without a shuffle. A small file in the folder states the columns and
buckets, so that any session can read it; no catalog service is needed, the session's own
catalog only names the folder.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from prefshare.functions.flags import quoted, sql_name

# The name starts like those of files that scans skip.
LAYOUT = "_layout"


@dataclass(frozen=True)
class Layout:
    """Columns as (name, type), the key they are bucketed by, the number of buckets and
    the columns that are folders."""

    columns: tuple[tuple[str, str], ...]
    key: str
    buckets: int
    folders: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Layout:
        told = json.loads(text)
        return Layout(
            tuple((name, kind) for name, kind in told["columns"]),
            told["key"],
            told["buckets"],
            tuple(told["folders"]),
        )


def _folder(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_bucketed(spark: SparkSession, path: str) -> bool:
    there, store = _folder(spark, f"{path.rstrip('/')}/{LAYOUT}/_SUCCESS")
    return store.exists(there)


def layout_of(spark: SparkSession, path: str) -> Layout:
    return Layout.from_json(spark.read.text(f"{path.rstrip('/')}/{LAYOUT}").first()[0])


def _state(spark: SparkSession, path: str, layout: Layout) -> None:
    told = spark.createDataFrame([(layout.to_json(),)], "value string").coalesce(1)
    told.write.mode("overwrite").text(f"{path.rstrip('/')}/{LAYOUT}")


def _named(spark: SparkSession, path: str, layout: Layout) -> str:
    """The folder's name in the session's catalog."""
    there, store = _folder(spark, path)
    where = store.makeQualified(there).toString()
    name = "prefshare_" + hashlib.sha256(where.encode()).hexdigest()[:24]
    columns = ", ".join(f"{sql_name(c)} {kind}" for c, kind in layout.columns)
    folders = ", ".join(map(sql_name, layout.folders))
    place = where.replace("\\", "\\\\").replace("'", "\\'")
    # Dropping the name leaves the files; another session may have changed the layout.
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        + (f"PARTITIONED BY ({folders}) " if folders else "")
        + f"CLUSTERED BY ({sql_name(layout.key)}) SORTED BY ({sql_name(layout.key)}) "
        f"INTO {layout.buckets} BUCKETS LOCATION '{place}'"
    )
    if folders:
        spark.catalog.recoverPartitions(name)
    return name


@contextmanager
def _only_written_folders(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the partitions it has rows for, when it is complete."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_bucketed(
    df: DataFrame,
    path: str,
    key: str,
    mode: str = "errorifexists",
    buckets: int | None = None,
    folders: Sequence[str] = (),
) -> None:
    """Write the rows by key; ``mode`` is ``errorifexists`` or ``overwrite``.

    With ``folders`` (columns) an existing folder keeps its layout and only the
    partitions of the rows are replaced, each as a whole. The number of buckets is that of
    shuffle partitions if not given. A key's rows are in one bucket: aggregate first where
    one key may have very many.
    """
    spark = df.sparkSession
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode} would break the buckets")
    there, store = _folder(spark, path)
    known = is_bucketed(spark, path)
    if store.exists(there):
        if mode == "errorifexists":
            raise FileExistsError(path)
        if not (known and folders):
            store.delete(there, True)
            known = False
    columns = [c for c in df.columns if c not in folders] + list(folders)
    if known:
        layout = layout_of(spark, path)
        if {c for c, _ in layout.columns} != set(columns) or layout.folders != tuple(folders):
            raise ValueError(f"{path} has other columns: {layout.columns}")
        columns = [c for c, _ in layout.columns]
    else:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        layout = Layout(
            tuple((c, kinds[c]) for c in columns),
            key,
            buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
            tuple(folders),
        )
    if folders and not known:
        _state(spark, path, layout)
    name = _named(spark, path, layout)
    dealt = df.select(*map(quoted, columns)).repartition(layout.buckets, quoted(layout.key))
    with _only_written_folders(spark):
        dealt.write.insertInto(name, overwrite=True)
    if not folders:
        # The overwrite has emptied the folder; without a layout it counts as unfinished.
        _state(spark, path, layout)


def folder_values(spark: SparkSession, path: str, folder: str) -> list[str]:
    """The values of a folder column that have rows, from the listing."""
    there, store = _folder(spark, f"{path.rstrip('/')}/{folder}=*")
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = store.globStatus(there) or []
    return sorted(plain(f.getPath().getName())[len(folder) + 1 :] for f in found)


def drop_folder(spark: SparkSession, path: str, folder: str, value: str) -> None:
    """Take the rows of that value out."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    there, store = _folder(spark, f"{path.rstrip('/')}/{folder}={escaped}")
    store.delete(there, True)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows, which a group or join by the key takes as they are stored."""
    return spark.table(_named(spark, path, layout_of(spark, path)))
