"""Package preferences: which buckets each current package falls in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefshare.functions import vocab
from prefshare.functions.binning import bucket_label
from prefshare.functions.flags import flag_columns
from prefshare.operators import names
from prefshare.operators.dedupe import first_per_key
from prefshare.operators.index import package_index
from prefshare.plans.inputs import PackageInputs


def binned_attributes(inputs: PackageInputs) -> DataFrame:
    """Attributes with a plan type, their numbers turned into bucket labels."""
    return inputs.attributes.na.drop(subset=["size"]).select(
        "package_name",
        bucket_label(F.col("duration"), inputs.duration_rules).alias("duration"),
        bucket_label(F.col("price"), inputs.price_rules).alias("price"),
        "size",
    )


def package_labels(inputs: PackageInputs) -> DataFrame:
    """One row per current package: package, duration, price, size.

    Of several old names with the same current name, the smallest promotion
    code decides.
    """
    bridge = names.name_bridge(inputs.old_tariff, inputs.new_tariff, inputs.hint)
    current = names.attributes_with_current_name(
        binned_attributes(inputs), bridge, inputs.hint
    ).where(F.col("package").isNotNull())
    return first_per_key(current, ["package"], ["promotion_code", "package_name"]).select(
        "package", "duration", "price", "size"
    )


def bought_package_labels(
    inputs: PackageInputs, bought: DataFrame | None = None
) -> DataFrame:
    """Labels of the packages somebody bought; ``bought`` takes their names where
    they are known already."""
    if bought is None:
        bought = names.bought_packages(
            inputs.transactions, inputs.new_tariff, inputs.hint
        )
    return package_labels(inputs).join(inputs.hint(bought), "package", "left_semi")


def preference_flags(inputs: PackageInputs) -> list[Column]:
    return [
        *flag_columns(F.col("duration"), vocab.STEP_LABELS, vocab.DURATION_PREFIX),
        *flag_columns(F.col("price"), vocab.STEP_LABELS, vocab.PRICE_PREFIX),
        *flag_columns(F.col("size"), inputs.size_labels, vocab.SIZE_PREFIX),
    ]


def package_preferences(
    inputs: PackageInputs,
    with_name: bool = False,
    bought: DataFrame | None = None,
) -> DataFrame:
    """``id`` in package-name order and one 0/1 flag per bucket.

    ``bought`` takes the bought packages' labels where they are staged already.
    """
    labels = bought_package_labels(inputs) if bought is None else bought
    indexed = package_index(labels, "package", few=inputs.few_packages)
    name = ["package"] if with_name else []
    return indexed.select("id", *name, *preference_flags(inputs))
