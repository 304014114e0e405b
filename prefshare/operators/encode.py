"""One-hot encoding and label discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from prefshare.functions.flags import flag_columns, quoted

def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def column_labels(df: DataFrame, column: str) -> list:
    """Sorted non-null labels that become columns.

    They are the schema of a wide table, which the driver holds in any case; a
    caller who cannot have that many columns keeps the tall form.
    """
    named = distinct_labels(df, column).where(quoted(column).isNotNull())
    return sorted(r[0] for r in named.collect())


def one_hot(
    df: DataFrame,
    column: str,
    labels: Sequence | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Replace a label column by one 0/1 column per label.

    With ``labels`` the schema is fixed and needs no pass over the data;
    without, the labels found in the data are used.
    """
    if labels is None:
        labels = column_labels(df, column)
    kept = [quoted(c) for c in df.columns if c != column]
    return df.select(*kept, *flag_columns(quoted(column), labels, prefix or column))
