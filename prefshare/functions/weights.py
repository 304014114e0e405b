"""Column-wise products and quotients over all feature columns at once.

Tables may have hundreds of feature columns; as SQL text they reach the session
in one call.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import sql_name


def share(part: Column, total: Column) -> Column:
    """Quotient that is null, not an error, for a zero total."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def scale_columns(df: DataFrame, weight: str, keep: Collection[str]) -> DataFrame:
    """Multiply every column but ``keep`` and the weight itself by the weight."""
    fixed = {weight, *keep}
    names = [(c, sql_name(c)) for c in df.columns]
    return df.selectExpr(
        [n if c in fixed else f"{n} * {sql_name(weight)} AS {n}" for c, n in names]
    )


def share_columns(df: DataFrame, total: str, keep: Collection[str]) -> DataFrame:
    """Divide every column but ``keep`` by the total, then drop the total."""
    divisor = f"CAST({sql_name(total)} AS DOUBLE)"
    names = [(c, sql_name(c)) for c in df.columns if c != total]
    return df.selectExpr(
        [
            n if c in keep else f"try_divide(CAST({n} AS DOUBLE), {divisor}) AS {n}"
            for c, n in names
        ]
    )
