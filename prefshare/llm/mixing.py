"""Mixing sources to target weights by proportionate-fair scheduling.

A source of integer weight a among weights that sum to L gets block i (from 0)
released at slot floor(i L / a) and due at slot ceil((i + 1) L / a). Taking the
released block with the earliest deadline fills every slot and meets every
deadline, so after any number of slots each source has less than one block more
or less than its share.

The schedule repeats after L slots, one *round* in which a source gives as many
blocks as its weight. So only rounds that differ are scheduled: they change when
a source has no full round left, at most twice for each source. From then on the
others share its slots by their weights; no row is dropped or repeated. All of
it is DataFrame expressions: each span of rounds that are alike is scheduled in a row
that holds the sources' weights and block counts, and a row finds its slot by its rank
within its source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import fresh_name, group_ranks
from prefshare.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from prefshare.sources.scratch import stage

BLOCK_ROWS = 64
MOST_WEIGHT = 10_000

# The source of the earliest deadline among the blocks released at slot t.
_PICK = """
array_min(transform(sequence(0, size(active) - 1), j ->
  if(acc.done[j] < active[j].give
       and (acc.done[j] * slots) div active[j].give <= t,
     struct((((acc.done[j] + 1) * slots + active[j].give - 1) div active[j].give) as due,
            j as j),
     null))).j
"""
_SCHEDULE = f"""
aggregate(
  sequence(0L, slots - 1),
  cast(struct(transform(active, x -> 0L) as done, array() as order)
       as struct<done: array<bigint>, order: array<int>>),
  (acc, t) -> transform(array({_PICK}), p -> struct(
      transform(acc.done, (d, i) -> if(i = p, d + 1, d)) as done,
      concat(acc.order, array(active[p].stream)) as order))[0],
  acc -> acc.order)
"""


def _schedules(sizes: DataFrame, block_rows: int) -> DataFrame:
    """Rows (stream, weight, from_round, to_round, base, slots, places, late, late_before)
    from rows (stream, weight, rows), one for each stream and each span of rounds that
    are alike. ``places`` are the stream's slots in one round, ``base`` the slots before
    ``from_round``; ``late`` holds the last blocks of streams that end in these rounds and
    are short, as their slots and the rows they lack, and ``late_before`` the rows that
    were lacking before. Rows are at most twice the square of the number of streams."""
    spark = sizes.sparkSession
    streams = stage(
        sizes.select(
            "stream",
            "weight",
            F.expr(f"(rows + {block_rows - 1}) div {block_rows}").alias("blocks"),
            F.expr(f"pmod(-rows, {block_rows})").alias("lack"),
        ),
        "mix-streams",
    )
    one = streams.agg(
        F.sort_array(F.collect_list(F.struct("stream", "weight", "blocks"))).alias("src")
    ).filter("size(src) > 0")
    rounds = "((x.blocks + x.weight - 1) div x.weight)"
    cuts = F.expr(
        "array_sort(array_distinct(concat(array(0L), flatten(transform(src, x ->"
        f" array({rounds} - 1, {rounds}))))))"
    )
    following = F.explode(
        F.expr("transform(cuts, (c, i) -> struct(c as start, get(cuts, i + 1) as next))")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    active = F.expr(
        "transform(filter(src, x -> x.blocks > from_round * x.weight), x ->"
        " struct(x.stream as stream, least(x.weight, x.blocks - from_round * x.weight) as give))"
    )
    # Each span of rounds is scheduled by itself, once.
    scheduled = stage(
        one.withColumn("cuts", cuts)
        .withColumn("cut", following)
        .withColumn("from_round", F.col("cut.start"))
        .withColumn("to_round", F.col("cut.next"))
        .filter("to_round is not null")
        .repartition(tasks, "from_round")
        .withColumn(
            "base",
            F.expr(
                "aggregate(src, 0L, (a, x) -> a + least(x.blocks, from_round * x.weight))"
            ),
        )
        .withColumn("active", active)
        .withColumn("slots", F.expr("aggregate(active, 0L, (a, x) -> a + x.give)"))
        .withColumn("order", F.expr(_SCHEDULE))
        .select("from_round", "to_round", "base", "slots", "order"),
        "mix-schedules",
    )
    span = ["from_round", "to_round", "base", "slots"]
    parts = (
        scheduled.select(*span, F.posexplode("order").alias("k", "stream"))
        .groupBy(*span, "stream")
        .agg(F.sort_array(F.collect_list(F.col("k").cast("bigint"))).alias("places"))
        .join(streams, "stream")
        .withColumn("last", F.expr("(blocks - 1) div weight"))
    )
    short = F.expr(
        """if(lack > 0 and last >= from_round and last < to_round,
        struct(base + (last - from_round) * slots + places[cast((blocks - 1) % weight as int)]
               as slot, lack as lack), null)"""
    )
    rows = stage(
        parts.select("stream", "weight", *span, "places", short.alias("short")), "mix-rounds"
    )
    before = Window.orderBy("from_round").rowsBetween(Window.unboundedPreceding, -1)
    late = rows.groupBy("from_round").agg(
        F.collect_list("short").alias("late"), F.sum("short.lack").alias("lacks")
    )
    late = late.select(
        "from_round",
        "late",
        F.coalesce(F.sum("lacks").over(before), F.lit(0)).alias("late_before"),
    )
    return rows.drop("short").join(late, "from_round")


def _streams(spark: SparkSession, weights: Mapping[str, int]) -> DataFrame:
    """Rows (name, stream, weight) of the named sources."""
    return (
        spark.range(1)
        .select(
            F.lit(list(weights)).cast("array<string>").alias("names"),
            F.lit([int(w) for w in weights.values()]).cast("array<bigint>").alias("weights"),
        )
        .select(F.posexplode(F.arrays_zip("names", "weights")).alias("stream", "pair"))
        .select(
            F.col("pair.names").alias("name"), "stream", F.col("pair.weights").alias("weight")
        )
    )


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that have one; it tells rows of one key apart."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*map(quoted, plain))


def mix(
    df: DataFrame,
    weights: Mapping[str, int],
    rest: int,
    source: str = "source",
    order: tuple[str, ...] = ("doc_id",),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows with ``mix_block`` (number of the row's block within its source),
    ``mix_slot`` (the block's place among all blocks) and ``mix_position`` (the
    row's place among all rows, gapless from 0).

    ``weights`` gives named sources their integer weights; all other sources,
    and a null source, are one stream of weight ``rest``. A source's rows stand in a
    hashed order of ``order`` and, where that is equal, of the whole row, so that every
    run gives a row the same place; nulls there are values like any other. Only rows that
    are equal in every column may swap places. Columns of the three names are replaced. An
    empty table gives no rows.
    """
    values = [*weights.values(), rest]
    if any(int(w) != w or w < 1 for w in values) or sum(values) > MOST_WEIGHT:
        raise ValueError(f"weights are whole, positive and sum to {MOST_WEIGHT} at most")
    added = ("mix_block", "mix_slot", "mix_position")
    columns = [c for c in df.columns if c.casefold() not in added]
    stream, rank = fresh_name(df, "_stream"), fresh_name(df, "_rank")
    rows = df.select(*map(quoted, columns))
    same = fresh_name(df, "_same")
    if weights:
        # One row for each named source: as many as the caller lists.
        named = _streams(df.sparkSession, weights).select(F.struct("*").alias(same))
        rows = rows.join(
            broadcast_if_small(named), quoted(source) == F.col(f"{same}.name"), "left"
        )
        number, weight = F.col(f"{same}.stream"), F.col(f"{same}.weight")
    else:
        number = weight = F.lit(None)
    rows = rows.select(
        *map(quoted, columns),
        F.coalesce(number.cast("int"), F.lit(len(weights))).alias(stream),
        F.coalesce(weight.cast("bigint"), F.lit(int(rest))).alias(same),
    )
    sizes = rows.groupBy(quoted(stream)).agg(
        F.first(quoted(same)).alias("weight"), F.count(F.lit(1)).alias("rows")
    )
    sizes = sizes.withColumnRenamed(stream, "stream")
    rows = rows.drop(same)
    plan = _schedules(sizes, block_rows)
    own = fresh_name(df, "_plan")
    plan = stage(plan.select(F.struct(*plan.columns).alias(own)), "mix-plan")
    held = F.lit(100) + 8 * (F.size(f"{own}.places") + 2 * F.size(f"{own}.late"))
    if (plan.agg(F.sum(held)).first()[0] or 0) <= BROADCAST_BYTES:
        plan = F.broadcast(plan)
    total = rows.count()
    ranked = group_ranks(
        rows, [stream], [*[quoted(c) for c in order], row_hash(rows)], rank, total
    )
    block = F.expr(f"`{rank}` div {block_rows}")
    slot = F.expr(
        f"{own}.base + (mix_block div {own}.weight - {own}.from_round) * {own}.slots"
        f" + {own}.places[cast(mix_block % {own}.weight as int)]"
    )
    # Blocks before are full, but for the last ones of sources that have ended.
    position = F.expr(
        f"mix_slot * {block_rows} + `{rank}` % {block_rows} - {own}.late_before"
        f" - aggregate({own}.late, 0L, (a, x) -> a + if(x.slot < mix_slot, x.lack, 0L))"
    )
    return (
        ranked.withColumn("mix_block", block)
        .join(
            plan,
            (quoted(stream) == F.col(f"{own}.stream"))
            & (F.expr(f"mix_block div {own}.weight >= {own}.from_round"))
            & (F.expr(f"mix_block div {own}.weight < {own}.to_round")),
        )
        .withColumn("mix_slot", slot)
        .withColumn("mix_position", position)
        .select(*map(quoted, columns), *added)
    )


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The rows in mix order: partitions follow each other, and so do the files
    and rows of a table that is written from them."""
    return mixed.repartitionByRange("mix_position").sortWithinPartitions("mix_position")
