"""Id ranges and their union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_between(
    df: DataFrame, low: int | None, high: int | None, name: str = "id"
) -> DataFrame:
    """Rows with ``low <= id <= high``; an end that is None is open."""
    if low is not None:
        df = df.where(F.col(name) >= low)
    return df if high is None else df.where(F.col(name) <= high)


def id_from(df: DataFrame, low: int, name: str = "id") -> DataFrame:
    """Rows with ``id >= low``."""
    return df.where(F.col(name) >= low)


def union_ranges(df: DataFrame, starts: Sequence[int], name: str = "id") -> DataFrame:
    """Disjoint ranges from each start to the next, the last one open, in one.

    Equal to ``id_from(df, starts[0])``; for results that were made per range.
    """
    if list(starts) != sorted(set(starts)):
        raise ValueError("range starts must ascend without repeats")
    ends = [F.col(name) < following for following in starts[1:]] + [F.lit(True)]
    parts = [
        (F.col(name) >= low) & end for low, end in zip(starts, ends, strict=True)
    ]
    # The ranges do not overlap: one pass that keeps the rows of any is their union.
    return df.where(reduce(lambda a, b: a | b, parts))
