"""Matrices as tall (row, col, value) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from prefshare.sources.scratch import stage

# Entries of one factor in a block of the blocked product.
BLOCK_ENTRIES = 10_000


def to_tall(df: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """Wide rows to their non-zero entries; ``col`` holds the column name."""
    entries = df.unpivot(quoted(row), [quoted(c) for c in columns], "col", "value")
    return entries.where(F.col("value") != 0).select(
        quoted(row).alias("row"), "col", "value"
    )


def to_wide(tall: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Entries back to one row per matrix row; absent entries are 0."""
    wide = tall.groupBy("row").pivot("col", list(columns)).agg(F.sum("value"))
    return wide.select(
        "row", *[F.coalesce(quoted(c), F.lit(0)).alias(c) for c in columns]
    )


def tall_product(
    left: DataFrame, right: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Matrix product of two tall tables: join on the shared index, sum.

    ``left`` is (row, col, value), ``right`` is (row, col, value) with its row
    the left column. Absent entries count as 0, absent result rows are empty.
    Each left entry meets the entries of one right row only: for bucket flags
    that is a handful.
    """
    factors = right.select(
        F.col("row").alias("inner"),
        F.col("col").alias("out"),
        F.col("value").alias("factor"),
    )
    pairs = left.withColumnRenamed("col", "inner").join(
        broadcast_if_small(factors, limit), "inner"
    )
    return (
        pairs.groupBy("row", "out")
        .agg(F.sum(F.col("value") * F.col("factor")).alias("value"))
        .withColumnRenamed("out", "col")
    )


def block_units(
    left: DataFrame, right: DataFrame, entries: int = BLOCK_ENTRIES, limit: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """The factors dealt into units (inner, i, j): row block i of the left entries of an
    inner index, column block j of the right ones.

    An inner index with more than ``entries`` entries on a side is cut there in blocks, by
    the hash of the row or column; its blocks are repeated for every block of the other
    side. All others are one unit. The counts that decide it are per inner index.
    """
    sizes = [
        side.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(F.col(key).alias("inner"), "n")
        for side, key in ((left, "col"), (right, "row"))
    ]
    # Only an index that both sides have makes products.
    hot = (
        sizes[0]
        .withColumnRenamed("n", "l")
        .join(sizes[1].withColumnRenamed("n", "r"), "inner")
        .where(F.greatest("l", "r") > entries)
        .select(
            "inner",
            F.ceil(F.col("l") / entries).cast("int").alias("rows"),
            F.ceil(F.col("r") / entries).cast("int").alias("cols"),
        )
    )
    hot = broadcast_if_small(stage(hot, "hot-inner"), limit)
    one = F.lit(1)

    def dealt(side: DataFrame, own: str, mine: str, others: str) -> DataFrame:
        cut = side.join(hot, "inner", "left").select(
            *side.columns,
            F.pmod(F.xxhash64(own), F.coalesce(mine, one)).cast("int").alias("_own"),
            F.explode(F.sequence(F.lit(0), F.coalesce(others, one) - 1)).alias("_other"),
        )
        names = ("_i", "_j") if own == "row" else ("_j", "_i")
        return cut.withColumnsRenamed(dict(zip(("_own", "_other"), names, strict=True)))

    first = left.select("row", F.col("col").alias("inner"), "value")
    second = right.select(
        F.col("row").alias("inner"), F.col("col").alias("out"), F.col("value").alias("factor")
    )
    return dealt(first, "row", "rows", "cols"), dealt(second, "out", "cols", "rows")


def block_product(
    left: DataFrame, right: DataFrame, entries: int = BLOCK_ENTRIES, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``tall_product`` of two matrices that are both too large to be broadcast.

    Entries meet by inner index and block: a unit has about ``entries`` of each factor at
    most, so that an inner index on which very many rows and columns meet is spread over
    tasks. Products are summed in their task before the partial sums move to their cell.
    """
    first, second = block_units(left, right, entries, limit)
    return (
        first.join(second, ["inner", "_i", "_j"])
        .groupBy("row", "out")
        .agg(F.sum(F.col("value") * F.col("factor")).alias("value"))
        .withColumnRenamed("out", "col")
    )
