"""The customer score products."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.operators import names
from prefshare.operators.index import dense_index
from prefshare.operators.scores import (
    DURATION,
    Buckets,
    bucket_scores,
    bucket_sums,
)
from prefshare.operators.sizing import repeated_bytes
from prefshare.plans.inputs import PackageInputs
from prefshare.plans.preferences import binned_attributes, package_labels


def labelled_purchases(inputs: PackageInputs) -> DataFrame:
    """Named purchases with the bucket labels of their package, if it has any.

    The package tables are joined with each other first, so the purchases meet
    a single table, in a single join.
    """
    codes = names.current_names(inputs.new_tariff)
    profile = codes.join(inputs.hint(package_labels(inputs)), "package", "left")
    # The profile repeats its labels for every code of a package, so it may be
    # larger than the masters it is made of.
    most = repeated_bytes(codes, binned_attributes(inputs).drop("package_name"))
    if most <= inputs.broadcast_limit:
        profile = F.broadcast(profile)
    return inputs.transactions.where(F.col("analytic_id").isNotNull()).join(
        profile, "package_id"
    )


def customer_scores(inputs: PackageInputs, scores: Sequence[Buckets]) -> DataFrame:
    """One row per customer, one share per bucket of the given scores.

    All scores asked for come from the same pass over the purchases.
    """
    return bucket_scores(
        labelled_purchases(inputs), ["analytic_id"], "total_transaction", scores
    )


def indexed_scores(inputs: PackageInputs, scores: Sequence[Buckets]) -> DataFrame:
    """``customer_scores`` with the customer's dense ``id``."""
    return dense_index(customer_scores(inputs, scores), "analytic_id")


def raw_range_scores(
    inputs: PackageInputs,
    score: Buckets = DURATION,
    id_range: tuple[int | None, int | None] = (None, None),
    excluded: Collection[str] = (),
    keep_part: bool = False,
) -> DataFrame:
    """Purchase counts, not shares, per bucket; of all customers, or those of the
    id range the caller gives, and without the packages the caller excludes.

    Customers are numbered before packages are excluded: a customer who bought
    nothing else keeps their place. ``keep_part`` keeps the number of the ordered part
    that holds a row.
    """
    labelled = labelled_purchases(inputs)
    if excluded:
        counted = ~F.col("package").isin(list(excluded))
        labelled = labelled.withColumn(
            score.attribute, F.when(counted, F.col(score.attribute))
        )
    sums = bucket_sums(labelled, ["analytic_id"], "total_transaction", [score])
    return dense_index(
        sums.drop("total"), "analytic_id", id_range=id_range, keep_part=keep_part
    )
