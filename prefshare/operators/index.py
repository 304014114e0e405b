"""Dense 0-based row ids in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.operators.sizing import fits
from prefshare.sources.ordered import read_ordered, write_ordered
from prefshare.sources.scratch import scratch_path


def dense_index(
    df: DataFrame,
    key: str,
    name: str = "id",
    id_range: tuple[int | None, int | None] = (None, None),
    keep_part: bool = False,
) -> DataFrame:
    """Number all rows 0..N-1 by a unique key without one task seeing them all.

    The rows are range-partitioned, sorted once and written in order to the shared
    scratch folder; the number is a row's place in its range plus the rows of the ranges
    before. Reading back what was written, rather than computing it twice, is what makes
    the ids exact and lets a lost executor's work be read again. Of an ``id_range`` (ends
    included, None is open) only the parts that hold it are read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "dense-index")
    write_ordered(df, path, key, stated=False)
    return read_ordered(spark, path, name, *id_range, keep_part, df.schema)


def package_index(
    df: DataFrame, key: str, name: str = "id", few: bool | None = None
) -> DataFrame:
    """The same numbering for a package-sized table: one window, no files.

    ``few`` says whether the table is that small where this is known; otherwise
    it is measured.
    """
    if not (fits(df) if few is None else few):
        return dense_index(df, key, name)
    row = F.row_number().over(Window.orderBy(quoted(key)))
    return df.select(
        (row - 1).cast("bigint").alias(name), *[quoted(c) for c in df.columns]
    )
