"""Promotion codes and old package names to current package names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.operators.dedupe import first_per_key
from prefshare.operators.sizing import broadcast_if_small

Hint = Callable[[DataFrame], DataFrame]


def name_bridge(
    old_tariff: DataFrame, new_tariff: DataFrame, hint: Hint = broadcast_if_small
) -> DataFrame:
    """One current name per old name: that of its smallest promotion code.

    Old names whose code the new tariff does not list stay, with a null name.
    """
    current = new_tariff.select(
        "promotion_code", F.col("package_name").alias("package")
    )
    listed = old_tariff.select("promotion_code", "package_name").join(
        hint(current), "promotion_code", "left"
    )
    return first_per_key(listed, ["package_name"], ["promotion_code", "package"])


def attributes_with_current_name(
    attributes: DataFrame, bridge: DataFrame, hint: Hint = broadcast_if_small
) -> DataFrame:
    """Attributes of every old name, with its current name and its code."""
    return attributes.join(hint(bridge), "package_name", "left")


def current_names(new_tariff: DataFrame) -> DataFrame:
    """Package id and current name; a repeated code stays repeated."""
    return new_tariff.where(F.col("package_name").isNotNull()).select(
        F.col("promotion_code").alias("package_id"),
        F.col("package_name").alias("package"),
    )


def name_transactions(
    transactions: DataFrame, new_tariff: DataFrame, hint: Hint = broadcast_if_small
) -> DataFrame:
    """Purchases of packages that have a current name."""
    return transactions.join(hint(current_names(new_tariff)), "package_id").select(
        "analytic_id", "package", "total_transaction"
    )


def bought_packages(
    transactions: DataFrame, new_tariff: DataFrame, hint: Hint = broadcast_if_small
) -> DataFrame:
    """Distinct current names that occur in the purchases.

    Codes are made distinct first: that collapses the fact inside each task,
    and the join and second distinct run on codes only.
    """
    codes = transactions.select("package_id").distinct()
    return (
        codes.join(hint(current_names(new_tariff)), "package_id")
        .select("package")
        .distinct()
    )
