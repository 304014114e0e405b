"""Customers as sparse rows: sorted arrays in place of one column for each package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.functions.weights import share, share_columns
from prefshare.operators.scores import Buckets
from prefshare.operators.sizing import BROADCAST_BYTES, broadcast_if_small


def sparse_rows(
    quantities: DataFrame, package_ids: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per customer: analytic_id, total, package_ids, quantities, shares.

    ``quantities`` are (analytic_id, package, qty), one row for each pair; ``package_ids``
    are (package, package_id). The arrays follow the package id and hold what was bought of
    packages that have one; the total counts every package. A zero total has null shares
    of the packages that are listed, which are those of a quantity other than 0. A
    customer's arrays are as long as the packages bought, however many there are.
    """
    known = quantities.join(broadcast_if_small(package_ids, limit), "package", "left")
    entry = F.when(
        F.col("package_id").isNotNull() & (F.col("qty") != 0),
        F.struct("package_id", "qty"),
    )
    grouped = known.groupBy("analytic_id").agg(
        F.sum("qty").alias("total"), F.sort_array(F.collect_list(entry)).alias("bought")
    )
    return grouped.select(
        "analytic_id",
        "total",
        F.transform("bought", lambda x: x["package_id"]).alias("package_ids"),
        F.transform("bought", lambda x: x["qty"]).alias("quantities"),
        F.transform("bought", lambda x: share(x["qty"], F.col("total"))).alias("shares"),
    )


def sparse_entries(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, total, package_id and qty, one row for each array entry; a customer with empty
    arrays keeps one row with nulls."""
    pair = F.explode_outer(F.arrays_zip("package_ids", "quantities")).alias("_pair")
    return rows.select(*map(quoted, keys), "total", pair).select(
        *map(quoted, keys),
        "total",
        F.col("_pair.package_ids").alias("package_id"),
        F.col("_pair.quantities").alias("qty"),
    )


def sparse_scores(
    rows: DataFrame,
    preferences: DataFrame,
    keys: Sequence[str],
    scores: Sequence[Buckets],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Scores of sparse rows: each entry meets the flags of its package id.

    The entries of a customer stand together, so they are summed to one row in the task
    that unpacks them; what is shuffled is one narrow row per customer.
    """
    columns = [c for s in scores for c in s.columns]
    flags = preferences.select(F.col("id").alias("package_id"), *map(quoted, columns))
    matched = sparse_entries(rows, keys).join(
        broadcast_if_small(flags, limit), "package_id", "left"
    )
    none = F.lit(0)
    sums = [
        F.coalesce(F.sum(F.when(quoted(c) == 1, F.col("qty"))), none).alias(c)
        for c in columns
    ]
    totalled = matched.groupBy(*map(quoted, keys), "total").agg(*sums)
    return share_columns(totalled, "total", keep=keys)
