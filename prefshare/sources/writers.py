"""Delimited, Parquet and text sinks, and the preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.sources.bucketed import write_bucketed


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "|",
    mode: str = "errorifexists",
    single_file: bool = False,
) -> None:
    """Header CSV folder; with ``single_file`` one part, whatever the size, which
    is for package-sized tables."""
    if single_file:
        # A shuffle, not coalesce: the work before it keeps its parallelism.
        df = df.repartition(1)
    df.write.mode(mode).option("sep", sep).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    table_format: str = "csv",
    mode: str = "errorifexists",
    key: str | None = None,
) -> None:
    """A derived table, as pipe-delimited text or as Parquet, which keeps its rows by the
    key if one is given."""
    if table_format == "parquet" and key is not None:
        write_bucketed(df, path, key, mode)
    elif table_format == "parquet":
        write_parquet(df, path, mode)
    else:
        write_delimited(df, path, mode=mode)


def vector_text(key: str, values: Sequence[str]) -> Column:
    """``key|[v1, v2, ...]`` as one text column."""
    # A null keeps its place as a word.
    numbers = F.concat_ws(
        ", ", *[F.coalesce(quoted(v).cast("string"), F.lit("null")) for v in values]
    )
    return F.concat(
        quoted(key).cast("string"), F.lit("|["), numbers, F.lit("]")
    ).alias("value")


def write_vectors(
    df: DataFrame,
    path: str,
    key: str,
    values: Sequence[str],
    mode: str = "errorifexists",
    part: str | None = None,
) -> None:
    """Text folder of vectors; each line keeps its row key.

    With the ``part`` of rows that were read from ordered files, each part is a folder
    of its own and its lines are in order of the key: no shuffle, no second sort of all.
    """
    lines = vector_text(key, values)
    if part is None:
        df.select(lines).write.mode(mode).text(path)
        return
    ordered = df.sortWithinPartitions(quoted(part), quoted(key)).select(lines, quoted(part).alias("part"))
    ordered.write.mode(mode).partitionBy("part").text(path)


def preview(df: DataFrame, order: str = "id", rows: int = 20) -> DataFrame:
    """The first rows by an order column (a per-task top-k, no full sort)."""
    return df.orderBy(order).limit(rows)
