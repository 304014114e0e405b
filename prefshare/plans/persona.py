"""Customer persona: each customer's share of purchases per package."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions.weights import share, share_columns
from prefshare.operators import names
from prefshare.operators.encode import column_labels
from prefshare.operators.index import dense_index
from prefshare.operators.sparse import sparse_rows
from prefshare.operators.persona import (
    all_quantities,
    package_quantities,
    package_shares,
    quantity_totals,
    widen,
    with_customer,
)
from prefshare.plans.inputs import PackageInputs
from prefshare.plans.preferences import bought_package_labels
from prefshare.sources.ordered import write_ordered
from prefshare.sources.scratch import stage


def named_purchases(inputs: PackageInputs) -> DataFrame:
    return names.name_transactions(
        inputs.transactions, inputs.new_tariff, inputs.hint
    )


def persona_quantities(inputs: PackageInputs) -> DataFrame:
    return package_quantities(named_purchases(inputs))


def persona_tall(inputs: PackageInputs) -> DataFrame:
    """analytic_id, package, qty, total, share over all named purchases."""
    return package_shares(persona_quantities(inputs), inputs.few_packages)


@dataclass(frozen=True)
class StagedQuantities:
    """Quantities per customer and package, written once.

    What else a product needs of the purchases comes from them: the bought
    packages, which nobody's purchases count for as well, and the customers.
    """

    rows: DataFrame

    @property
    def bought(self) -> DataFrame:
        return self.rows.select("package").distinct()

    @property
    def tall(self) -> DataFrame:
        return with_customer(self.rows)


def staged_quantities(inputs: PackageInputs) -> StagedQuantities:
    """The one pass over the purchases."""
    return StagedQuantities(stage(all_quantities(named_purchases(inputs)), "quantities"))


def _wide_source(
    inputs: PackageInputs, packages: Sequence[str] | None
) -> tuple[DataFrame, list[str]]:
    """Tall quantities, and the packages that become columns: those handed in, or
    the bought ones."""
    if packages is not None:
        return persona_quantities(inputs), list(packages)
    staged = staged_quantities(inputs)
    return staged.tall, column_labels(staged.bought, "package")


def persona_quantities_wide(
    inputs: PackageInputs, packages: Sequence[str] | None = None
) -> DataFrame:
    """``analytic_id`` and one quantity column per bought or given package."""
    tall, columns = _wide_source(inputs, packages)
    # The tall rows move to their customer before they turn wide.
    return widen(tall.repartition("analytic_id"), ["analytic_id"], columns, "qty")


def persona_shares_wide(
    inputs: PackageInputs, packages: Sequence[str] | None = None
) -> DataFrame:
    """``analytic_id`` and one share column per bought or given package."""
    tall, columns = _wide_source(inputs, packages)
    # The tall rows move to their customer before they turn wide. Divided after widening, so
    # that a zero total is null in every column.
    counts = widen(
        tall.repartition("analytic_id"), ["analytic_id"], columns, "qty", total="total"
    )
    return share_columns(counts, "total", keep=["analytic_id"])


def numbered_quantities(tall: DataFrame) -> DataFrame:
    """analytic_id, package, qty, total and the customer's dense ``id``.

    ``tall`` is read twice, because the ids need all customers first. These are
    numbered as narrow rows and meet the tall ones, so no wide row is ever
    sorted or staged. A customer has one row among them, so a task holds its customers
    and lets the tall rows pass, which need no sort.
    """
    customers = dense_index(quantity_totals(tall), "analytic_id")
    return tall.join(customers.hint("shuffle_hash"), "analytic_id")


def customer_persona_tall(
    inputs: PackageInputs, staged: StagedQuantities | None = None
) -> DataFrame:
    """The persona with one row per customer and package, for any number of them.

    Packages without attributes are kept: they are part of the total.
    """
    staged = staged or staged_quantities(inputs)
    return numbered_quantities(staged.tall).select(
        "id",
        "analytic_id",
        "package",
        "qty",
        "total",
        share(F.col("qty"), F.col("total")).alias("share"),
    )


def customer_persona(
    inputs: PackageInputs,
    staged: StagedQuantities | None = None,
    packages: Sequence[str] | None = None,
) -> DataFrame:
    """``id``, ``analytic_id`` and one share column per master package.

    The columns are those given, or the bought packages that have attributes, in
    preference-id order. Purchases of other packages count in the total but get
    no column.
    """
    staged = staged or staged_quantities(inputs)
    if packages is None:
        labels = bought_package_labels(inputs, staged.bought)
        packages = column_labels(labels, "package")
    keys = ["id", "analytic_id"]
    counts = widen(numbered_quantities(staged.tall), [*keys, "total"], packages, "qty")
    return share_columns(counts, "total", keep=keys)


def write_sparse_persona(
    inputs: PackageInputs,
    preferences: DataFrame,
    path: str,
    mode: str = "errorifexists",
    staged: StagedQuantities | None = None,
) -> None:
    """The persona as one sparse row per customer, in a folder in id order.

    ``preferences`` (id, package, flags) gives the packages their ids. The rows are sorted
    once, by customer; their ids come from that order.
    """
    staged = staged or staged_quantities(inputs)
    ids = preferences.select("package", F.col("id").alias("package_id"))
    rows = sparse_rows(staged.tall, ids, inputs.broadcast_limit)
    write_ordered(rows, path, "analytic_id", mode)
