"""Customer scores: how much of the purchases falls in each bucket."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions import vocab
from prefshare.functions.flags import quoted, safe_name, sql_name
from prefshare.functions.weights import share_columns
from prefshare.operators.sizing import BROADCAST_BYTES, broadcast_if_small


@dataclass(frozen=True)
class Buckets:
    """The labels of one package attribute that a score reports."""

    attribute: str
    prefix: str
    labels: tuple[str, ...]

    def column(self, label: str) -> str:
        return safe_name(f"{self.prefix}_{label}")

    @property
    def columns(self) -> list[str]:
        return [self.column(label) for label in self.labels]


DURATION = Buckets("duration", vocab.DURATION_PREFIX, vocab.STEP_LABELS)
PRICE = Buckets("price", vocab.PRICE_PREFIX, vocab.STEP_LABELS)
QUOTA = Buckets("size", vocab.SIZE_PREFIX, vocab.QUOTA_LABELS)
SPEED = Buckets("size", vocab.SIZE_PREFIX, vocab.SPEED_LABELS)


def bucket_sums(
    labelled: DataFrame,
    keys: Sequence[str],
    quantity: str,
    scores: Sequence[Buckets],
) -> DataFrame:
    """Quantity per key in each bucket, and ``total``, in one aggregate.

    Flags are 0 or 1, so the product of quantities and flags is this sum. Tasks
    combine their rows before the shuffle, which leaves a hot key one row per
    task.
    """
    amount, none = F.col(quantity), F.lit(0)
    sums = [
        F.coalesce(F.sum(F.when(F.col(s.attribute) == label, amount)), none).alias(
            s.column(label)
        )
        for s in scores
        for label in s.labels
    ]
    return labelled.groupBy(*keys).agg(F.sum(amount).alias("total"), *sums)


def bucket_scores(
    labelled: DataFrame,
    keys: Sequence[str],
    quantity: str,
    scores: Sequence[Buckets],
) -> DataFrame:
    """Share of a key's quantity in each bucket.

    Whole quantities are summed first and divided once, so the result does not
    depend on the order of the rows. A zero total gives null scores.
    """
    return share_columns(
        bucket_sums(labelled, keys, quantity, scores), "total", keep=keys
    )


def tall_scores(
    persona: DataFrame,
    preferences: DataFrame,
    keys: Sequence[str],
    scores: Sequence[Buckets],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Scores of tall persona rows, matched to the flags by package name.

    For persona tables with too many packages to be columns.
    """
    columns = [c for s in scores for c in s.columns]
    flags = preferences.select("package", *[quoted(c) for c in columns])
    matched = persona.join(broadcast_if_small(flags, limit), "package", "left")
    quantity, none = F.col("qty"), F.lit(0)
    sums = [
        F.coalesce(F.sum(F.when(quoted(c) == 1, quantity)), none).alias(c)
        for c in columns
    ]
    totalled = matched.groupBy(*keys).agg(F.sum(quantity).alias("total"), *sums)
    return share_columns(totalled, "total", keep=keys)


def project_scores(
    persona: DataFrame,
    preferences: DataFrame,
    keys: Sequence[str],
    scores: Sequence[Buckets],
) -> DataFrame:
    """Scores of wide persona rows, whose columns after the keys are packages.

    The flags are found by package name: tables of different runs do not match
    and are refused. A wide row holds all its customer's packages, so with the
    flags as plan constants the product is a projection: no join, no shuffle. The
    flags fetched are one row per persona column.
    """
    packages = [c for c in persona.columns if c not in keys]
    columns = [c for s in scores for c in s.columns]
    # One row more than there are columns shows that the tables differ.
    flags = preferences.select("package", *[quoted(c) for c in columns])
    found = {r["package"]: r for r in flags.limit(len(packages) + 1).collect()}
    if set(found) != set(packages):
        other = sorted(map(str, set(found) ^ set(packages)))
        raise ValueError(
            f"packages of the persona and the preferences differ: {', '.join(other[:10])}"
        )
    rows = [found[p] for p in packages]

    # Shares of a zero total are null in every column, and so are its scores.
    nothing = f"{sql_name(packages[0])} * 0" if packages else "0"

    def total_of(column: str) -> str:
        members = [sql_name(p) for p, r in zip(packages, rows) if r[column]]
        return f"CAST({_sum_text(members) or nothing} AS DOUBLE) AS {sql_name(column)}"

    return persona.selectExpr(*keys, *[total_of(c) for c in columns])


def _sum_text(terms: list[str]) -> str:
    """Sum of the terms, halved over and over so that it does not nest deeply."""
    if len(terms) < 2:
        return "".join(terms)
    half = len(terms) // 2
    return f"({_sum_text(terms[:half])} + {_sum_text(terms[half:])})"
