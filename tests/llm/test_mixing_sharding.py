"""Mixing against a sequential schedule, sharding against running sums."""

import zlib

import pytest

from prefshare.llm import mixing, sharding


def schedule(blocks, weights):
    """Earliest deadline first, slot by slot, in rounds of the sources' weights."""
    given = dict.fromkeys(blocks, 0)
    out = []
    while any(given[s] < blocks[s] for s in blocks):
        give = {s: min(weights[s], blocks[s] - given[s]) for s in sorted(blocks) if blocks[s] > given[s]}
        total, done = sum(give.values()), dict.fromkeys(give, 0)
        for t in range(total):
            due, s = min(
                (-(-(done[s] + 1) * total // give[s]), s)
                for s in give
                if done[s] < give[s] and done[s] * total // give[s] <= t
            )
            assert due > t
            out.append((s, given[s] + done[s]))
            done[s] += 1
        for s in give:
            given[s] += give[s]
    return out


SCHEMA = "doc_id long, source string, text string, mix_slot string, _rank string, _plan int"


def sources(spark, n):
    names = ["a", "b", "c", None, "z"]
    rows = [
        (i if i % 11 else None, names[(i * i + i // 7) % 5] if i % 3 else "a", None, "x", "y", 1)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "block, weights, rest",
    [(8, {"a": 3, "b": 5, "c": 2}, 4), (64, {"a": 1}, 1), (1, {"b": 7, "c": 1, "none": 3}, 2)],
)
def test_mix_is_the_earliest_deadline_schedule(spark, block, weights, rest):
    mixed = mixing.mix(sources(spark, 900), weights, rest, block_rows=block)
    assert mixed.columns == [
        "doc_id", "source", "text", "_rank", "_plan", "mix_block", "mix_slot", "mix_position",
    ]
    rows = sorted(mixed.collect(), key=lambda r: r.mix_position)
    assert [r.mix_position for r in rows] == list(range(900))
    number = {name: i for i, name in enumerate(weights)}
    streams = [number.get(r.source, len(weights)) for r in rows]
    blocks = {s: -(-streams.count(s) // block) for s in set(streams)}
    expected = schedule(blocks, {**{number[k]: w for k, w in weights.items()}, len(weights): rest})
    assert [expected[r.mix_slot] for r in rows] == [
        (s, r.mix_block) for s, r in zip(streams, rows, strict=True)
    ]
    assert [r.mix_slot for r in rows] == sorted(r.mix_slot for r in rows)


def test_shares_stay_within_a_block(spark):
    weights = {"a": 5, "b": 3}
    mixed = mixing.mix(sources(spark, 1500), weights, 2, block_rows=1)
    rows = sorted(mixed.collect(), key=lambda r: r.mix_slot)
    streams = [r.source if r.source in weights else None for r in rows]
    shares = {"a": 0.5, "b": 0.3, None: 0.2}
    ends = min(max(i for i, s in enumerate(streams) if s == name) for name in shares)
    seen = dict.fromkeys(shares, 0)
    for t, s in enumerate(streams[: ends - 10], 1):
        seen[s] += 1
        assert all(abs(seen[name] - w * t) < 1 for name, w in shares.items())


def test_mix_of_nothing_and_of_one_source(spark):
    assert mixing.mix(sources(spark, 0), {"a": 1}, 1).count() == 0
    same = spark.createDataFrame([(1, "a")] * 130, "doc_id long, source string")
    rows = mixing.mix(same, {"a": 2}, 1).collect()
    assert sorted(r.mix_position for r in rows) == list(range(130))
    with pytest.raises(ValueError, match="whole"):
        mixing.mix(same, {"a": 0}, 1)


def test_very_many_sources(spark):
    names = [f"s{i:04d}" for i in range(2_000)]
    rows = [(i, names[i % 2_000]) for i in range(2_600)] + [(9_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = mixing.mix(docs, dict.fromkeys(names, 2), 5, block_rows=1).collect()
    assert sorted(r.mix_position for r in out) == list(range(len(rows)))
    assert sorted((r.doc_id, r.source) for r in out if r.source) == sorted(rows[:-1])


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_rows_of_one_id_keep_their_places(spark, monkeypatch, limit):
    """Whatever order and partitions the rows come in, and however the plan is joined."""
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", limit)
    rows = [(i % 7 or None, "ab"[i % 3 % 2], f"text {i}") for i in range(400)]

    def mixed(some, parts):
        docs = spark.createDataFrame(some, "doc_id long, source string, text string").repartition(parts)
        frame = mixing.mix(docs, {"a": 2, "b": 3}, 1, block_rows=8)
        return sorted((r.mix_position, r.text, r.mix_slot) for r in frame.collect())

    first = mixed(rows, 3)
    assert [p for p, *_ in first] == list(range(400))
    assert mixed(rows[::-1], 5) == first


def test_mix_order_is_written(spark):
    mixed = mixing.mix(sources(spark, 400), {"a": 1, "b": 1}, 1, block_rows=4)
    parts = mixing.in_mix_order(mixed).rdd.map(lambda r: r.mix_position).glom().collect()
    assert [x for p in parts for x in p] == list(range(400))


def test_mixing_plan_has_no_python(spark, capsys):
    mixing.mix(sources(spark, 10), {"a": 1}, 1).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_shards_are_contiguous_and_near_equal(spark):
    texts = ["é" * (i * 37 % 91) for i in range(500)] + [None, "", "x" * 3000]
    ids = [i // 2 for i in range(len(texts))]  # repeated ids
    rows = [(i, t, 7, "s") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string")
    sizes = sharding.document_sizes(docs)
    cut = sharding.assign_shards(sizes, ["doc_id", "text_crc32", "size"], "size", 8)
    got = cut.collect()
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in order] == sorted(ids)
    expected = sorted(
        (i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1)
        for i, t in zip(ids, texts, strict=True)
    )
    assert [(r.doc_id, r.text_crc32, r.size) for r in order] == expected
    total, largest = sum(x[2] for x in expected), max(x[2] for x in expected)
    for shard in range(8):
        own = [r for r in order if r.shard == shard]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 8) <= largest


def test_shards_keep_columns_of_clashing_names(spark):
    rows = [(i, 10, "p", "b", "f") for i in range(16)]
    df = spark.createDataFrame(rows, "id long, size long, _part string, _base string, _first string")
    got = sharding.assign_shards(df, ["id"], "size", 8)
    assert got.columns == [*df.columns, "shard", "slot"]
    assert sorted((r.id, r.shard, r.slot, r._base) for r in got.collect()) == [
        (i, i // 2, i % 2, "b") for i in range(16)
    ]


def test_shards_of_few_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (1, None)], "doc_id long, text string")
    cut = sharding.assign_shards(sharding.document_sizes(docs), ["doc_id", "text_crc32"], "size", 8)
    assert sorted((r.doc_id or 0, r.shard, r.slot) for r in cut.collect()) == [(0, 2, 0), (1, 6, 0)]
    none = sharding.document_sizes(docs.limit(0))
    assert sharding.assign_shards(none, ["doc_id"], "size", 8).count() == 0
