"""Folders of rows in key order, with gapless ids that cost no second sort.

The rows are range-partitioned and sorted once. Each range is a folder ``part=N`` that
holds its rows in order, with their place; a manifest beside them holds the rows and the
first id of every part. A row's id is the first one of its part plus its place, so ids
come with reading, and a range of ids reads the parts that hold it and no others.

Range edges are sampled and may differ between runs; ids do not, for they follow from what
was written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefshare.functions.flags import quoted

MANIFEST, COLUMNS = "_manifest", "_columns"
PART, PLACE = "_part", "_place"
COUNTS = "part int, first bigint, rows bigint"


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}/{MANIFEST}"


def write_ordered(
    df: DataFrame, path: str, key: str, mode: str = "errorifexists", stated: bool = True
) -> None:
    """Write the rows in order of a key that no two rows share; null comes first.

    The columns are stated in the folder for later sessions, if ``stated``. The manifest
    comes last: a folder without it is not complete.
    """
    taken = {c.casefold() for c in df.columns} & {PART, PLACE}
    if taken:
        raise ValueError(f"columns are named like the folder's own: {sorted(taken)}")
    part = F.spark_partition_id()
    # The generated id is the partition number above 33 bits of row count.
    place = F.monotonically_increasing_id() - F.shiftleft(quoted(PART).cast("bigint"), 33)
    ranged = df.repartitionByRange(quoted(key)).withColumn(PART, part)
    # Ordered by part as well, so that the writer sees no need to sort.
    placed = ranged.sortWithinPartitions(PART, quoted(key)).withColumn(PLACE, place)
    placed.write.mode(mode).partitionBy(PART).parquet(path)
    spark = df.sparkSession
    if stated:
        told = spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1)
        told.write.mode(mode).text(f"{path.rstrip('/')}/{COLUMNS}")
    schema = f"{PART} int, {PLACE} bigint"
    sizes = spark.read.schema(schema).parquet(path).groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    # One row for each range, as many as there were shuffle partitions.
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("bigint")
    manifest = sizes.select(F.col(PART).alias("part"), first.alias("first"), "rows")
    manifest.coalesce(1).write.mode(mode).parquet(_manifest_path(path))


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """Rows (part, first, rows), one for each part."""
    return spark.read.schema(COUNTS).parquet(_manifest_path(path))


def _held(low: int | None, high: int | None) -> Column:
    """Whether a part of the manifest holds ids from low to high, ends included."""
    held = F.lit(True)
    if low is not None:
        held = held & (F.col("first") + F.col("rows") > low)
    return held if high is None else held & (F.col("first") <= high)


def read_ordered(
    spark: SparkSession,
    path: str,
    name: str = "id",
    low: int | None = None,
    high: int | None = None,
    keep_part: bool = False,
    columns: T.StructType | None = None,
) -> DataFrame:
    """The rows with their ids as the first column, those from ``low`` to ``high`` where
    given; other parts are not read. Files hold the rows in order; ``keep_part`` keeps the
    part's number. ``columns`` are those that were written, if known."""
    if columns is None:
        told = spark.read.text(f"{path.rstrip('/')}/{COLUMNS}").first()[0]
        columns = T.StructType.fromJson(json.loads(told))
    own = [T.StructField(PLACE, T.LongType()), T.StructField(PART, T.IntegerType())]
    schema = T.StructType([*columns.fields, *own])
    rows = spark.read.schema(schema).parquet(path)
    parts = manifest_of(spark, path)
    if low is not None or high is not None:
        # Parts follow each other, so two numbers name those of a range of ids.
        ends = parts.where(_held(low, high)).agg(F.min("part"), F.max("part")).first()
        held = F.col(PART).between(ends[0], ends[1]) if ends[0] is not None else F.lit(False)
        rows = rows.where(held)
    first = "_first"
    while first in {c.casefold() for c in columns.names}:
        first = "_" + first
    starts = parts.select(F.col("part").alias(PART), F.col("first").alias(first))
    number = (F.col(first) + F.col(PLACE)).cast("bigint")
    rows = rows.join(F.broadcast(starts), PART)
    if low is not None:
        rows = rows.where(number >= low)
    if high is not None:
        rows = rows.where(number <= high)
    kept = [quoted(c) for c in columns.names] + ([F.col(PART)] if keep_part else [])
    return rows.select(number.alias(name), *kept)


def parts_in_order(spark: SparkSession, path: str, name: str = "id") -> Iterator[DataFrame]:
    """One frame for each part, in order of the ids; each is read by itself."""
    starts = manifest_of(spark, path).where("rows > 0").orderBy("part").collect()
    for part in starts:
        last = part["first"] + part["rows"] - 1
        rows = read_ordered(spark, path, name, part["first"], last)
        yield rows.orderBy(name)
