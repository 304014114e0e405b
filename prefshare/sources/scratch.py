"""Folder for tables that cut lineage or are handed between jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Lists that take the paths given out while they are here.
_noted: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master without that setting makes a temporary folder of its
    own: executors on other machines could not see it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="prefshare-"))
        base = context.getCheckpointDir()
    path = os.path.join(base, f"{label}-{uuid.uuid4().hex}")
    for paths in _noted:
        paths.append(path)
    return path


@contextmanager
def removed_afterwards(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables named inside when the work with them is over."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.remove(paths)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            store.delete(path, True)


def stage(df: DataFrame, label: str, folders: Sequence[str] = ()) -> DataFrame:
    """The frame as a written table: what reads it twice computes it once. With
    ``folders``, the last columns, reading some of their values leaves the others out."""
    path = scratch_path(df.sparkSession, label)
    write = df.write.partitionBy(*folders) if folders else df.write
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
