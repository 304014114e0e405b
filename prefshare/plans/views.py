"""SQL over the tables: views of the inputs and products, statements with parameters.

Names and values reach a statement as parameters, names through ``IDENTIFIER``; the text
of a statement depends on the number of its columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from prefshare.functions.flags import sql_name, unique_names
from prefshare.plans.inputs import PackageInputs
from prefshare.plans.persona import named_purchases, persona_quantities
from prefshare.plans.preferences import package_labels

INPUTS = ("transactions", "old_tariff", "new_tariff", "attributes")


def create_views(inputs: PackageInputs, prefix: str = "") -> list[str]:
    """Temporary views of the inputs, ``named`` (purchases of named packages),
    ``quantities`` (per customer and package) and ``labels`` (per package); their names,
    with the prefix. Views of these names are replaced."""
    views = {name: getattr(inputs, name) for name in INPUTS}
    views["named"] = named_purchases(inputs)
    views["quantities"] = persona_quantities(inputs)
    views["labels"] = package_labels(inputs)
    names = []
    for name, frame in views.items():
        names.append(prefix + name)
        frame.createOrReplaceTempView(prefix + name)
    return names


def drop_views(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)


def shares_sql(packages: int) -> str:
    """Shares of so many packages per customer, from the view :view; packages are :p0, :p1
    and their columns :c0, :c1."""
    columns = "".join(
        f",\n  try_divide(coalesce(sum(qty) FILTER (WHERE package = :p{i}), 0D),"
        f" sum(qty)) AS IDENTIFIER(:c{i})"
        for i in range(packages)
    )
    return f"SELECT analytic_id{columns}\nFROM IDENTIFIER(:view) GROUP BY analytic_id"


def persona_shares_sql(
    spark: SparkSession, packages: Sequence[str], view: str = "quantities"
) -> DataFrame:
    """``analytic_id`` and one share column per given package, by SQL over the view."""
    unique_names(["analytic_id", *packages])
    args = {"view": sql_name(view)}
    args |= {f"p{i}": name for i, name in enumerate(packages)}
    args |= {f"c{i}": sql_name(name) for i, name in enumerate(packages)}
    return spark.sql(shares_sql(len(packages)), args=args)
