"""Command-line jobs: files in, files out.

``preprocess`` writes the two derived tables, ``score`` scores them, ``scores``
goes from purchases to all scores in one pass, ``raw-duration`` writes the
raw-count vectors of one customer id range. ``put-month`` adds a month of purchases to
a folder of months, or replaces it; the others take that folder in place of files.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from prefshare.functions import vocab
from prefshare.functions.flags import quoted
from prefshare.operators.scores import (
    DURATION,
    PRICE,
    QUOTA,
    SPEED,
    Buckets,
    project_scores,
    tall_scores,
)
from prefshare.operators.sparse import sparse_scores
from prefshare.plans.batches import ranges_of, write_ranges
from prefshare.plans.inputs import PackageInputs, read_inputs
from prefshare.operators.encode import column_labels
from prefshare.plans.months import put_month, quantities_of
from prefshare.plans.persona import (
    customer_persona,
    customer_persona_tall,
    staged_quantities,
    write_sparse_persona,
)
from prefshare.plans.preferences import bought_package_labels, package_preferences
from prefshare.plans.scores import indexed_scores, raw_range_scores
from prefshare.plans.session import build_session
from prefshare.sources import readers, writers
from prefshare.sources.ordered import PART, read_ordered
from prefshare.sources.scratch import removed_afterwards, stage

SCORES: dict[str, Buckets] = {
    "duration": DURATION,
    "price": PRICE,
    "quota": QUOTA,
    "unlimited": SPEED,
}
KEYS = ["analytic_id", "id"]


def _keys_first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*KEYS, *[quoted(c) for c in columns])


def preprocess(
    inputs: PackageInputs,
    out: str,
    mode: str = "errorifexists",
    table_format: str = "csv",
    shape: str = "tall",
) -> None:
    """``package_preferences`` as one file, ``customer_persona`` as many.

    The tall persona has a row per customer and package, the wide one a column
    per package; both are matched with the preferences by package name. The sparse one
    has a row per customer with arrays of package ids, those of the preferences.
    """
    # Both tables come from the quantities; the purchases are read once.
    staged = staged_quantities(inputs)
    labels = stage(bought_package_labels(inputs, staged.bought), "bought-packages")
    flags = package_preferences(inputs, with_name=True, bought=labels)
    if shape == "sparse":
        flags = stage(flags, "preferences")
    path = os.path.join(out, "package_preferences")
    if table_format == "parquet":
        writers.write_parquet(flags, path, mode)
    else:
        writers.write_delimited(flags, path, mode=mode, single_file=True)
    if shape == "sparse":
        write_sparse_persona(
            inputs, flags, os.path.join(out, "customer_persona"), mode, staged
        )
        return
    if shape == "tall":
        persona = customer_persona_tall(inputs, staged)
    else:
        persona = customer_persona(inputs, staged, column_labels(labels, "package"))
    writers.write_table(
        persona,
        os.path.join(out, "customer_persona"),
        table_format,
        mode,
        # Tall rows stay with their customer, for the jobs that read them.
        key="analytic_id" if shape == "tall" else None,
    )


def score(
    spark: SparkSession,
    kind: str,
    preferences: str,
    persona: str,
    out: str,
    mode: str = "errorifexists",
    table_format: str = "csv",
    shape: str = "tall",
) -> None:
    """One score of the derived tables."""
    scorer = tall_scores if shape == "tall" else project_scores
    scored = scorer(
        readers.read_features(spark, persona, table_format),
        readers.read_features(spark, preferences, table_format),
        KEYS,
        [SCORES[kind]],
    )
    key = "analytic_id" if shape == "tall" else None
    writers.write_table(scored, out, table_format, mode, key=key)


def score_by_ranges(
    spark: SparkSession,
    kind: str,
    preferences: str,
    persona: str,
    out: str,
    batch: int,
    table_format: str = "csv",
    most: int | None = None,
) -> None:
    """One score of a sparse persona, written range by range of ``batch`` customers, small
    ranges by one job. The same call goes on where a run was stopped."""
    flags = readers.read_features(spark, preferences, table_format)

    def rows(low: int, high: int) -> DataFrame:
        some = read_ordered(spark, persona, low=low, high=high)
        return sparse_scores(some, flags, KEYS, [SCORES[kind]])

    write_ranges(spark, out, ranges_of(spark, persona, batch), rows, kind, most, name="id")


def all_scores(
    inputs: PackageInputs,
    out: str,
    mode: str = "errorifexists",
    table_format: str = "csv",
) -> None:
    """All scores from the purchases: one pass, one folder per score."""
    scored = indexed_scores(inputs, list(SCORES.values()))
    for kind, buckets in SCORES.items():
        writers.write_table(
            _keys_first(scored, buckets.columns),
            os.path.join(out, kind),
            table_format,
            mode,
        )


def raw_duration(
    inputs: PackageInputs,
    out: str,
    mode: str = "errorifexists",
    id_range: tuple[int | None, int | None] = (None, None),
    excluded: Sequence[str] = (),
) -> None:
    """Raw-count duration vectors in id order, each with its id: folders ``part=N`` that
    follow each other."""
    raw = raw_range_scores(
        inputs, id_range=id_range, excluded=excluded, keep_part=True
    )
    writers.write_vectors(raw, out, "id", DURATION.columns, mode=mode, part=PART)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="prefshare", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("preprocess", "scores", "raw-duration"):
        job = jobs.add_parser(name)
        read = job.add_mutually_exclusive_group(required=True)
        read.add_argument("--transactions", nargs="+")
        read.add_argument("--months", help="folder kept by put-month")
        for source in ("old-tariff", "new-tariff", "attributes"):
            job.add_argument(f"--{source}", required=True)
    raw = jobs.choices["raw-duration"]
    raw.add_argument("--id-from", type=int)
    raw.add_argument("--id-to", type=int)
    raw.add_argument("--exclude", nargs="*", default=())
    job = jobs.add_parser("put-month")
    job.add_argument("--transactions", required=True, nargs="+")
    job.add_argument("--month", required=True)
    job = jobs.add_parser("score")
    job.add_argument("--kind", choices=sorted(SCORES), required=True)
    job.add_argument("--preferences", required=True)
    job.add_argument("--persona", required=True)
    for name in ("preprocess", "scores", "score"):
        jobs.choices[name].add_argument(
            "--table-format", choices=("csv", "parquet"), default="csv"
        )
    for name in ("preprocess", "score"):
        jobs.choices[name].add_argument(
            "--shape", choices=("wide", "tall", "sparse"), default="tall"
        )
    jobs.choices["score"].add_argument(
        "--batch", type=int, default=200_000, help="customers of a range, sparse shape"
    )
    for job in jobs.choices.values():
        job.add_argument("--out", required=True)
        job.add_argument("--mode", default="errorifexists")
        job.add_argument("--shuffle-gb", type=float)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    if args.job == "score":
        read = [args.persona]
    else:
        read = args.transactions or [args.months]
    stated = None if args.shuffle_gb is None else int(args.shuffle_gb * 1024**3)
    spark = build_session(f"prefshare-{args.job}", read, stated)
    with removed_afterwards(spark):
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "put-month":
        rows = readers.read_transactions(spark, args.transactions)
        put_month(rows, args.out, args.month)
        return
    if args.job == "score" and args.shape == "sparse":
        score_by_ranges(
            spark,
            args.kind,
            args.preferences,
            args.persona,
            args.out,
            args.batch,
            args.table_format,
        )
        return
    if args.job == "score":
        score(
            spark,
            args.kind,
            args.preferences,
            args.persona,
            args.out,
            args.mode,
            args.table_format,
            args.shape,
        )
        return
    older = args.job == "raw-duration"
    bought = args.transactions
    inputs = read_inputs(
        spark,
        quantities_of(spark, args.months) if bought is None else bought,
        args.old_tariff,
        args.new_tariff,
        args.attributes,
        size_labels=vocab.OLDER_SIZE_LABELS if older else vocab.SIZE_LABELS,
    )
    if older:
        raw_duration(
            inputs, args.out, args.mode, (args.id_from, args.id_to), args.exclude
        )
    elif args.job == "scores":
        all_scores(inputs, args.out, args.mode, args.table_format)
    else:
        preprocess(inputs, args.out, args.mode, args.table_format, args.shape)
