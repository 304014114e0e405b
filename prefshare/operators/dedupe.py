"""One row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted, sql_name


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The row with the smallest ``order`` values per key, nulls last.

    A minimum, not a window: each task keeps one row per key before the
    shuffle, so a key with very many copies is no hot group. Ties fall to
    the remaining columns in their written order, nulls last as well.
    """
    rest = [c for c in df.columns if c not in keys]
    compared = [*order, *[c for c in rest if c not in order]]
    fields = [
        f"{sql_name(c)} IS NULL AS _n{i}, {sql_name(c)} AS _v{i}"
        for i, c in enumerate(compared)
    ]
    place = {c: i for i, c in enumerate(compared)}
    smallest = F.expr(f"min(struct({', '.join(fields)}))").alias("_first")
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(smallest)
        .selectExpr(
            *[sql_name(k) for k in keys],
            *[f"_first._v{place[c]} AS {sql_name(c)}" for c in rest],
        )
    )
