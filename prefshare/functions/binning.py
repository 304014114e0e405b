"""Numeric value to bucket label."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefshare.functions.vocab import DURATION_RULES, PRICE_RULES

Rule = tuple[str, str, float]

_COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    ">=": operator.ge,
    ">": operator.gt,
}


def bucket_label(value: Column, rules: Sequence[Rule]) -> Column:
    """One ``CASE WHEN`` over the number; null when no rule holds.

    Edges are compared as doubles, never as text, so 36.5 is above 36 and ANSI
    mode has no label to cast.
    """
    if not rules:
        raise ValueError("bucket_label needs at least one rule")
    number = value.cast("double")
    label = None
    for name, comparison, edge in rules:
        test = _COMPARE[comparison](number, F.lit(float(edge)))
        label = F.when(test, name) if label is None else label.when(test, name)
    return label


def duration_bucket(days: Column) -> Column:
    return bucket_label(days, DURATION_RULES)


def price_bucket(price: Column) -> Column:
    return bucket_label(price, PRICE_RULES)
