"""Quantities and shares per customer and package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import sql_name, unique_names
from prefshare.functions.weights import share

# Columns up to which a row is compared with each of them.
SUMMED_COLUMNS = 256


def with_customer(rows: DataFrame) -> DataFrame:
    """Rows without a customer belong to nobody and are left out."""
    return rows.where(F.col("analytic_id").isNotNull())


def customer_totals(named: DataFrame) -> DataFrame:
    return (
        with_customer(named)
        .groupBy("analytic_id")
        .agg(F.sum("total_transaction").alias("total"))
    )


def all_quantities(named: DataFrame) -> DataFrame:
    """Quantities per customer and package, those of nobody included."""
    return named.groupBy("analytic_id", "package").agg(
        F.sum("total_transaction").alias("qty")
    )


def package_quantities(named: DataFrame) -> DataFrame:
    """Tall counterpart of summing one flag column per package."""
    return all_quantities(with_customer(named))


def quantity_totals(quantities: DataFrame) -> DataFrame:
    return quantities.groupBy("analytic_id").agg(F.sum("qty").alias("total"))


def package_shares(quantities: DataFrame, few_packages: bool) -> DataFrame:
    """Each quantity with its customer's total and its share of it.

    A customer has one row per package by now, so with a small package table
    the total is a window over a small group. Otherwise one customer may still
    hold very many rows: the total is then aggregated apart and joined, which
    lets the runtime split that customer's rows over tasks.
    """
    if few_packages:
        mine = Window.partitionBy("analytic_id")
        totalled = quantities.withColumn("total", F.sum("qty").over(mine))
    else:
        totalled = quantities.join(quantity_totals(quantities), "analytic_id")
    return totalled.withColumn("share", share(F.col("qty"), F.col("total")))


def widen(
    tall: DataFrame,
    keys: Sequence[str],
    packages: Sequence[str],
    value: str,
    total: str | None = None,
) -> DataFrame:
    """One column per listed package, 0 where the customer has none.

    Rows of unlisted packages add no column but keep their customer, and count in the
    column ``total``, if one is named. Pass rows that are partitioned by customer already:
    else the mostly empty wide rows are what is shuffled.

    Up to ``SUMMED_COLUMNS`` packages are summed in one aggregate, which holds a row for
    each customer. A pivot holds one for each customer and package besides, but compares no
    row with every column, so it is left to wider tables.
    """
    own = [*keys] if total is None else [*keys, total]
    unique_names([*own, *packages])
    if len(packages) > SUMMED_COLUMNS:
        if total is not None:
            mine = Window.partitionBy(*keys)
            tall = tall.withColumn(total, F.sum(value).over(mine))
        wide = tall.groupBy(*own).pivot("package", list(packages)).agg(F.sum(value))
    else:
        sums = [] if total is None else [F.sum(value).alias(total)]
        for p in packages:
            amount = F.when(F.col("package") == F.lit(p), F.col(value))
            sums.append(F.sum(amount).alias(p))
        grouped = tall.groupBy(*keys)
        wide = grouped.agg(*sums) if sums else tall.select(*keys).distinct()
    return wide.selectExpr(
        *own, *[f"coalesce({sql_name(p)}, 0) AS {sql_name(p)}" for p in packages]
    )
