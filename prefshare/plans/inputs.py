"""The four tables every product is made from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.functions import vocab
from prefshare.functions.binning import Rule
from prefshare.operators.sizing import BROADCAST_BYTES, fits
from prefshare.sources import readers


@dataclass(frozen=True)
class PackageInputs:
    """Purchases and package masters, and the bins and labels to apply.

    ``transactions``: analytic_id, package_id, total_transaction
    ``old_tariff``, ``new_tariff``: promotion_code, package_name
    ``attributes``: package_name (old), duration, price, size
    """

    transactions: DataFrame
    old_tariff: DataFrame
    new_tariff: DataFrame
    attributes: DataFrame
    duration_rules: tuple[Rule, ...] = vocab.DURATION_RULES
    price_rules: tuple[Rule, ...] = vocab.PRICE_RULES
    size_labels: tuple[str, ...] = vocab.SIZE_LABELS
    broadcast_limit: int = BROADCAST_BYTES
    # Stored tables the package tables are views of; measured in their place.
    masters: tuple[DataFrame, ...] = ()

    @cached_property
    def few_packages(self) -> bool:
        """Whether the package tables, measured together, may be broadcast.

        It covers the joins of the masters with each other, where one row per
        code or name keeps the masters' own columns. What repeats them, like the
        labels of every code, is measured where it is broadcast.
        """
        masters = self.masters or (self.old_tariff, self.new_tariff, self.attributes)
        return fits(*masters, limit=self.broadcast_limit)

    def hint(self, packages: DataFrame) -> DataFrame:
        return F.broadcast(packages) if self.few_packages else packages


def read_inputs(
    spark: SparkSession,
    transactions: str | Sequence[str] | DataFrame,
    old_tariff: str,
    new_tariff: str,
    attributes: str,
    size_labels: tuple[str, ...] = vocab.SIZE_LABELS,
) -> PackageInputs:
    """Inputs from their delimited files; ``transactions`` may be several, such
    as one for each month, or a frame of purchases."""
    if not isinstance(transactions, DataFrame):
        transactions = readers.read_transactions(spark, transactions)
    return PackageInputs(
        transactions,
        readers.read_old_tariff(spark, old_tariff),
        readers.read_new_tariff(spark, new_tariff),
        readers.read_attributes(spark, attributes),
        size_labels=size_labels,
    )
