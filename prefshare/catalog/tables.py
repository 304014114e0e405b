"""The driver tables in the roles of purchases and package masters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.functions import vocab
from prefshare.operators.dedupe import first_per_key
from prefshare.operators.scores import Buckets
from prefshare.plans.inputs import PackageInputs

# Price edges that fill all five buckets with the part prices.
PART_PRICE_RULES = (
    ("XS", "<=", 910.0),
    ("S", "<=", 930.0),
    ("M", "<=", 950.0),
    ("L", "<=", 975.0),
    ("XL", ">", 975.0),
)
# The part names of the test tables at any scale factor, for wide tables whose
# columns are handed in.
PART_NAMES = tuple(
    f"{look} {thing}"
    for look in ("blue", "cold", "hot", "large", "new", "old", "red", "small")
    for thing in ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
)
# Part types stand for plan types; each label score reports half of them.
FIRST_TYPES = ("ECONOMY", "LARGE", "MEDIUM")
LAST_TYPES = ("PROMO", "SMALL", "STANDARD")
PART_TYPES = FIRST_TYPES + LAST_TYPES

LABEL_SUBSET = Buckets("size", vocab.SIZE_PREFIX, FIRST_TYPES)
LABEL_REST = Buckets("size", vocab.SIZE_PREFIX, LAST_TYPES)


# Stated so that no scan has to look into the files for its columns.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
    "events": "event_id bigint, user_id bigint, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order.

    A task holds its orders, the narrow side, and lets the line items pass, which need no
    sort.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").hint("shuffle_hash")
    return lines.join(
        orders, lines["l_orderkey"] == orders["o_orderkey"], "left"
    ).select(
        F.col("o_custkey").alias("analytic_id"),
        F.col("l_partkey").alias("package_id"),
        F.col("l_quantity").alias("total_transaction"),
    )


def purchases_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the year of their order (0 without one)."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").hint("shuffle_hash")
    return lines.join(
        orders, lines["l_orderkey"] == orders["o_orderkey"], "left"
    ).select(
        F.col("o_custkey").alias("analytic_id"),
        F.col("l_partkey").alias("package_id"),
        F.col("l_quantity").alias("total_transaction"),
        F.coalesce(F.year("o_orderdate"), F.lit(0)).alias("year"),
    )


def brand_attributes(part: DataFrame) -> DataFrame:
    """Attributes per brand (the old package name): those of its first part."""
    first = first_per_key(
        part.select("p_brand", "p_partkey", "p_size", "p_retailprice", "p_type"),
        ["p_brand"],
        ["p_partkey"],
    )
    return first.select(
        F.col("p_brand").alias("package_name"),
        F.col("p_size").cast("double").alias("duration"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("size"),
    )


def retail_inputs(spark: SparkSession, sf_dir: str, **settings) -> PackageInputs:
    """Customers buy parts: brands are old names, part names current ones."""
    part = table(spark, sf_dir, "part")
    return PackageInputs(
        transactions=purchases(spark, sf_dir),
        old_tariff=part.select(
            F.col("p_partkey").alias("promotion_code"),
            F.col("p_brand").alias("package_name"),
        ),
        new_tariff=part.select(
            F.col("p_partkey").alias("promotion_code"),
            F.col("p_name").alias("package_name"),
        ),
        attributes=brand_attributes(part),
        price_rules=PART_PRICE_RULES,
        size_labels=PART_TYPES,
        masters=(part,),
        **settings,
    )
