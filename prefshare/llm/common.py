"""Helpers that the operators share: names, ranks, packed rows, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.operators.sizing import broadcast_if_small
from prefshare.sources.scratch import stage

BUCKET_ROWS = 10_000
LEAST_BUCKETS = 1024
# Buckets whose sizes are summed in one window.
SUMMED_BUCKETS = 1000


def fresh_name(df: DataFrame, wish: str) -> str:
    """A column name that the frame does not have yet, whatever the letter case."""
    taken = {c.casefold() for c in df.columns}
    while wish.casefold() in taken:
        wish = "_" + wish
    return wish


def group_ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str, rows: int
) -> DataFrame:
    """Gapless 0-based ranks within each key, without a task that sees a whole key.
    Keys are not null.

    The rows of a key are dealt into hashed buckets; a row's rank is its place in
    the bucket plus the sizes of the key's buckets before. Places come from a
    window over (key, bucket), which holds about ``BUCKET_ROWS`` rows of the
    hottest key; sizes from a table with one row for each (key, bucket), summed in
    two steps over ranges of ``SUMMED_BUCKETS`` buckets. The
    hash and the order make the ranks the same in every run, so that a lost
    task can be repeated. ``rows`` is the number of rows of the frame.
    """
    buckets = max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
    bucket, start = fresh_name(df, "_bucket"), fresh_name(df, "_start")
    dealt = df.withColumn(
        bucket, F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(buckets)).cast("int")
    )
    both = [*keys, bucket]
    sizes = dealt.groupBy(*map(quoted, both)).agg(F.count(F.lit(1)).alias(start))
    span, base = fresh_name(dealt, "_span"), fresh_name(dealt, "_base")
    sizes = sizes.withColumn(span, F.expr(f"`{bucket}` div {SUMMED_BUCKETS}"))

    def before(of: list[str], along: str) -> WindowSpec:
        rows = Window.partitionBy(*map(quoted, of)).orderBy(quoted(along))
        return rows.rowsBetween(Window.unboundedPreceding, -1)

    own = fresh_name(dealt, "_own")
    spans = sizes.groupBy(*map(quoted, [*keys, span])).agg(F.sum(quoted(start)).alias(base))
    spans = spans.select(
        *[quoted(k).alias(fresh_name(dealt, f"_of{i}")) for i, k in enumerate(keys)],
        quoted(span).alias(own),
        F.coalesce(F.sum(quoted(base)).over(before(keys, span)), F.lit(0)).alias(base),
    )
    inside = F.coalesce(F.sum(quoted(start)).over(before([*keys, span], bucket)), F.lit(0))
    same = [quoted(k) == F.col(t) for k, t in zip([*keys, span], spans.columns, strict=False)]
    starts = sizes.withColumn(start, inside).join(spans, same)
    starts = starts.withColumn(start, quoted(start) + quoted(base))
    place = Window.partitionBy(*map(quoted, both)).orderBy(*order)
    placed = dealt.withColumn(rank, (F.row_number().over(place) - 1).cast("bigint"))
    # Plain equality, so that the join takes the rows as the window left them.
    theirs = [fresh_name(placed, f"_key{i}") for i in range(len(both))]
    starts = starts.select(
        *[quoted(k).alias(t) for k, t in zip(both, theirs, strict=True)], quoted(start)
    )
    equal = [quoted(k) == F.col(t) for k, t in zip(both, theirs, strict=True)]
    return placed.join(starts, equal).select(
        *map(quoted, df.columns),
        (quoted(rank) + quoted(start)).cast("bigint").alias(rank),
    )


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as text with empty strings for nulls."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all ranges start..start+length-1, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def rechunked(
    batches: Iterator[pa.RecordBatch], name: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the named text column holds about so many bytes each."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        size, rows = max(1, column.nbytes), batch.num_rows
        step = max(1, rows * most_bytes // size)
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of the edges (a, b): rows (node, component), the
    component being its smallest node. Nodes without an edge are not returned.

    Alternating rounds: each node links its larger neighbours to its smallest
    one, then its smaller ones. Aggregates combine before they shuffle, so a
    node with very many edges is not gathered in one place. Every round is
    written to the shared folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = stage(pairs.filter("a <> b").distinct(), label)
    if pairs.isEmpty():
        return spark.createDataFrame([], "node bigint, component bigint")
    while True:
        # Large star: every neighbour above a node goes to the node's least neighbour.
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every neighbour below a node, and the node, go to the least.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        following = moved.select("e.a", "e.b").filter("a <> b").distinct()
        following = stage(following, label)
        # Settled when every node has one edge and no edge leads to such a node.
        heads = following.select(F.col("b").alias("a")).distinct()
        state = following.agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("nodes")
        ).first()
        settled = state["n"] == state["nodes"] and (
            following.select("a").intersect(heads).isEmpty()
        )
        pairs = following
        if settled:
            break
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(heads.distinct())


def join_small(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """A join whose right side is broadcast if it measures small, else shuffled."""
    return left.join(broadcast_if_small(right), on, how)
