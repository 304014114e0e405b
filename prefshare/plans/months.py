"""Purchases kept month by month, as quantities that add up.

A month's purchases are summed per customer and package code and written as one partition
of a folder that is bucketed by customer. Adding or replacing a month reads that month
only. The months together stand for the purchases in every product: sums of sums are the
sums over all rows, without a shuffle of the months by customer.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.sources.bucketed import (
    drop_folder,
    folder_values,
    read_bucketed,
    write_bucketed,
)

MONTH = "month"
KEYS = ("analytic_id", "package_id")


def put_month(
    transactions: DataFrame, store: str, month: str, buckets: int | None = None
) -> None:
    """Add the month's purchases, or replace what the folder holds of that month.

    Purchases of nobody stay: their packages count as bought. Codes stay codes, so that
    a later tariff renames the months before as well. A month without any purchase has no
    partition; replacing a month by nothing takes ``drop_month``.
    """
    if not month:
        raise ValueError("a month needs a name")
    sums = transactions.groupBy(*KEYS).agg(
        F.sum("total_transaction").alias("total_transaction")
    )
    write_bucketed(
        sums.withColumn(MONTH, F.lit(month)),
        store,
        "analytic_id",
        mode="overwrite",
        buckets=buckets,
        folders=[MONTH],
    )


def drop_month(spark: SparkSession, store: str, month: str) -> None:
    """Take the month out of the folder."""
    drop_folder(spark, store, MONTH, month)


def months(spark: SparkSession, store: str) -> list[str]:
    """The months the folder holds, from its listing."""
    return folder_values(spark, store, MONTH)


def quantities_of(
    spark: SparkSession, store: str, only: Collection[str] | None = None
) -> DataFrame:
    """analytic_id, package_id, total_transaction over all months, or some: in place of
    purchases. Months that are not asked for are not read."""
    rows = read_bucketed(spark, store)
    if only is not None:
        rows = rows.where(F.col(MONTH).isin(list(only)))
    return rows.groupBy(*KEYS).agg(F.sum("total_transaction").alias("total_transaction"))

