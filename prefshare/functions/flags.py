"""0/1 flag columns and the names they are given."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sql_name(name: str) -> str:
    """The name as an SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by exact name."""
    return F.col(sql_name(name))


def safe_name(name: str) -> str:
    return name.replace(" ", "_")


def unique_names(names: Sequence[str]) -> list[str]:
    """Fail early when two labels end up as the same column; letter case does not
    tell columns apart."""
    counts = Counter(n.casefold() for n in names)
    doubled = sorted({n for n in names if counts[n.casefold()] > 1})
    if doubled:
        raise ValueError(
            f"column names collide: {', '.join(doubled)}; the tall shape takes any names"
        )
    return list(names)


def flag(column: Column, label) -> Column:
    """1 where the column equals the label, else 0; null counts as different."""
    return column.eqNullSafe(F.lit(label)).cast("int")


def flag_columns(column: Column, labels: Sequence, prefix: str) -> list[Column]:
    """One ``prefix_label`` flag per label; labels absent from the data give 0."""
    names = unique_names([safe_name(f"{prefix}_{label}") for label in labels])
    return [flag(column, label).alias(name) for label, name in zip(labels, names)]


def rename_safe(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return df.toDF(*unique_names([safe_name(c) for c in df.columns]))
