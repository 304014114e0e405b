"""Jaccard self-join of documents on word shingles with token-group matrices.

Tokens are hashed shingles; documents with equal token sets are one class. The
matrix says which groups hold a token in their token union; a class is compared
with the members of a group only if the tokens it shares with the union can
suffice.

1. Against the one group of all other classes: a class fewer than three quarters
   of whose tokens occur elsewhere has no link and leaves. This also gives the
   frequent tokens.
2. Each class lists its tokens, the frequent ones last; with a Jaccard index of
   0.75 its first quarter must hold the first token that the two sets share, and
   the tokens after that one must suffice. Every token's list is first compared
   with one class of it, the one with most frequent tokens, that is the common
   original of copies. Verified links make groups of similar classes.
3. The matrix of tokens and these groups: where a token occurs in several
   groups, classes are compared across groups. Inside a group all is linked
   already, so a large group of copies is not expanded into pairs.

Token lists travel as packed arrays, one row for each batch and token bucket. Tokens
that very many classes share do not: a sample of the texts names them, each in several
sampled classes, so they are known to be shared and are counted where the text is read.
In step 2 and 3 the list of a frequent token is cut in blocks of classes; step 2 takes a
star from each, step 3 compares each two blocks in a group of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import (
    components,
    fresh_name,
    join_small,
    rechunked,
    text_column,
)
from prefshare.llm.words import mixed, words_of
from prefshare.operators.sizing import broadcast_if_small
from prefshare.sources.scratch import stage

WORDS = 5
# Jaccard index of at least PARTS / 100.
PARTS = 75
CHUNK_BYTES = 3 << 20
# Tokens of a bucket, about: what one reduce task holds.
BUCKET_TOKENS = 1_000_000
LEAST_BUCKETS = 16
# A token in more classes than this is frequent; so many of the most frequent ones
# are told to the tasks. Both only order the tokens: any order gives all links.
FREQUENT = 16
MOST_FREQUENT = 500_000
# Distinct texts of the sample, about, and how many of them must share a hot token.
SAMPLED_TEXTS = 8_000
HOT_SAMPLED = 16
# Classes in a block of a frequent token's list, and pairs that are put out at once.
BLOCK_CLASSES = 2_048
PAIR_ROWS = 1_000_000
PACKED = "bucket int, packed binary"
SETS = "key bigint, n bigint, tokens binary"


def _need(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least intersection of sets of sizes n and m that links them:
    100 i >= PARTS (n + m - i)."""
    return -(-PARTS * (n + m) // (100 + PARTS))


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashed shingles of each text."""
    words = words_of(texts, lower=True)
    h = mixed(words.hashes())
    full = np.full(max(0, len(h) - size + 1), np.uint64(size))
    for k in range(size):
        full = mixed(full * np.uint64(0x9E3779B97F4A7C15) + h[k : len(full) + k])
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(full[a : b - size + 1]))
        else:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = mixed(
                    np.multiply(one, np.uint64(0x9E3779B97F4A7C15)) + x[None]
                )[0]
            out.append(np.array([one] if b > a else [], np.uint64))
    return out


def set_key(tokens: np.ndarray) -> int:
    """A hash of the set, as a signed number."""
    total = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mixed(total[None] + np.uint64(len(tokens))).view(np.int64)[0])


def _pack(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket with its part of the columns, one after the other."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = [*cuts[1:].tolist(), len(bucket)]
    columns = [c[order] for c in columns]
    rows = [
        b"".join(c[a:e].tobytes() for c in columns)
        for a, e in zip(cuts.tolist(), ends, strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts].astype(np.int32)), pa.array(rows, pa.binary())],
        ["bucket", "packed"],
    )


def _unpack(table: pa.Table, kinds: list[type]) -> list[np.ndarray]:
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for row in table["packed"]:
        raw = row.as_buffer()
        count, at = len(raw) // width, 0
        for part, kind in zip(parts, kinds, strict=True):
            part.append(np.frombuffer(raw, kind, count, at))
            at += part[-1].nbytes
    return [np.concatenate(p) for p in parts]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rechunked(batches, "_text", CHUNK_BYTES):
        sets = shingle_sets(text_column(batch, "_text"))
        keys = [set_key(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("doc_id")),
                batch.column(batch.schema.get_field_index("h")),
                pa.array(keys, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
            ],
            ["doc_id", "h", "key", "n"],
        )


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are among the ordered ones."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _token_rows(buckets: int, hot: np.ndarray):
    """Packed (class, its size, token) of a batch's distinct sets. A class has a
    number in its batch; its key and size stand once, in front of its tokens. Of the hot
    tokens only their number is put out, as (class, its size, count) in rows of negative
    buckets, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            found = {}
            for s in shingle_sets(text_column(batch, "_text")):
                if len(s):
                    found.setdefault(set_key(s), s)
            if not found:
                continue
            sizes = np.array([len(s) for s in found.values()], np.uint32)
            tokens = np.concatenate(list(found.values()))
            owner = np.repeat(np.arange(len(found), dtype=np.uint32), sizes)
            keys = np.array(list(found), np.int64)
            shared = _member(tokens, hot)
            if shared.any():
                count = np.bincount(owner[shared], minlength=len(found)).astype(np.uint32)
                some = np.flatnonzero(count)
                home = (mixed(keys[some].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                known = _pack(home, [keys[some], sizes[some], count[some]])
                below = np.int32(-1) - known.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(below, pa.int32()), known.column(1)], ["bucket", "packed"]
                )
                tokens, owner = tokens[~shared], owner[~shared]
                if not len(tokens):
                    continue
            bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket * len(found) + owner, kind="stable")
            bucket, owner = bucket[order], owner[order]
            low = tokens[order].astype(np.uint32)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = []
            for a, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
                first = np.flatnonzero(np.diff(owner[a:e].astype(np.int64), prepend=-1))
                own = owner[a:e][first]
                counts = np.diff(np.append(first, e - a)).astype(np.uint32)
                rows.append(
                    b"".join(
                        (
                            np.uint32(len(own)).tobytes(),
                            keys[own].tobytes(),
                            sizes[own].tobytes(),
                            counts.tobytes(),
                            low[a:e].tobytes(),
                        )
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts].astype(np.int32)), pa.array(rows, pa.binary())],
                ["bucket", "packed"],
            )

    return run


def _shared(buckets: int):
    """Per token bucket: how many of each class's tokens occur in other classes,
    packed by class; and frequent tokens, in rows with a null bucket."""

    def run(table: pa.Table) -> pa.Table:
        home = table["bucket"][0].as_py()
        if home < 0:
            # Numbers of hot tokens, from each batch that has the class.
            keys, sizes, counts = _unpack(table, [np.int64, np.uint32, np.uint32])
            key, first = np.unique(keys, return_index=True)
            home = np.full(len(key), -1 - home)
            return pa.Table.from_batches([_pack(home, [key, sizes[first], counts[first]])])
        keys, sizes, owners, tokens, base = [], [], [], [], 0
        for row in table["packed"]:
            raw = row.as_buffer()
            count = int(np.frombuffer(raw, np.uint32, 1)[0])
            keys.append(np.frombuffer(raw, np.int64, count, 4))
            sizes.append(np.frombuffer(raw, np.uint32, count, 4 + 8 * count))
            each = np.frombuffer(raw, np.uint32, count, 4 + 12 * count)
            owners.append(np.repeat(np.arange(base, base + count), each))
            tokens.append(np.frombuffer(raw, np.uint32, -1, 4 + 16 * count))
            base += count
        key, first, where = np.unique(
            np.concatenate(keys), return_index=True, return_inverse=True
        )
        n = np.concatenate(sizes)[first]
        # The same class may come from several batches.
        pairs = np.concatenate(tokens).astype(np.uint64) << np.uint64(32)
        pairs = np.unique(pairs | where[np.concatenate(owners)].astype(np.uint64))
        token, owner = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        cuts = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)))
        frequency = np.diff(np.append(cuts, len(token)))
        shared = np.repeat(frequency > 1, frequency)
        count = np.bincount(owner[shared].astype(np.int64), minlength=len(key))
        some = np.flatnonzero(count)
        home = (mixed(key[some].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        out = [
            pa.Table.from_batches(
                [_pack(home, [key[some], n[some], count[some].astype(np.uint32)])]
            )
        ] if len(some) else []
        often = np.flatnonzero(frequency > FREQUENT)
        if len(often):
            bucket = np.uint64(table["bucket"][0].as_py()) << np.uint64(32)
            raw = (bucket | token[cuts[often]]).tobytes() + frequency[often].astype(
                np.uint32
            ).tobytes()
            out.append(
                pa.table(
                    {"bucket": pa.array([None], pa.int32()), "packed": pa.array([raw], pa.binary())}
                )
            )
        empty = pa.table({"bucket": pa.array([], pa.int32()), "packed": pa.array([], pa.binary())})
        return pa.concat_tables(out) if out else empty

    return run


def _enough(table: pa.Table) -> pa.Table:
    """Classes of which PARTS percent of the tokens occur elsewhere."""
    keys, sizes, counts = _unpack(table, [np.int64, np.uint32, np.uint32])
    key, first, where = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(where, counts)
    kept = 100 * total >= PARTS * sizes[first].astype(np.float64)
    return pa.table({"key": pa.array(key[kept])})


def _unfold_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            count = len(raw) // 12
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(raw, np.int64, count)),
                    pa.array(np.frombuffer(raw, np.uint32, count, 8 * count), pa.int64()),
                ],
                ["token", "df"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each class from the text of one of its documents."""
    for batch in rechunked(batches, "_text", CHUNK_BYTES):
        wanted = batch.column(batch.schema.get_field_index("key")).to_pylist()
        sets = shingle_sets(text_column(batch, "_text"))
        # Another document may have the same doc_id.
        rows = [
            (k, len(s), s.tobytes())
            for k, s in zip(wanted, sets, strict=True)
            if len(s) and set_key(s) == k
        ]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.binary()),
            ],
            ["key", "n", "tokens"],
        )


_POSTING = [np.int64, np.int64, np.uint32, np.uint32, np.float32, np.uint64]


def _units(
    token: np.ndarray, key: np.ndarray, df: np.ndarray, pairs: bool, block: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the names of the lists they go to. The list of a token in more classes
    than a block holds is one for each block of classes, or with ``pairs`` for each two
    blocks, to which a class goes for every other block."""
    blocks = np.maximum(1, -(-df // block)).astype(np.uint64)
    own = mixed(key.view(np.uint64)) % blocks
    rows = np.arange(len(token))
    if pairs:
        count = blocks.astype(np.int64)
        rows = np.repeat(rows, count)
        other = (np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64)
    else:
        other = own
    lo, hi = np.minimum(own[rows], other), np.maximum(own[rows], other)
    part = mixed(lo * blocks[rows] + hi + np.uint64(1))
    return rows, np.where(blocks[rows] > 1, mixed(token[rows] ^ part), token[rows])


def _postings(
    token_buckets: int, buckets: int, frequent: np.ndarray, df: np.ndarray, pairs: bool
):
    """Packed (class, group, size, place, share of frequent tokens, list) of the
    tokens in front of each class's list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "tokens", CHUNK_BYTES):
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
            groups = batch.column(batch.schema.get_field_index("grp")).to_numpy()
            columns: list[list[np.ndarray]] = [[] for _ in _POSTING]
            often: list[np.ndarray] = []
            raws = batch.column(batch.schema.get_field_index("tokens"))
            for key, group, raw in zip(keys, groups, raws, strict=True):
                tokens = np.frombuffer(raw.as_buffer(), np.uint64)
                n = len(tokens)
                name = token_names(tokens, token_buckets)
                rank = np.zeros(n, np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, name), len(frequent) - 1)
                    rank = np.where(frequent[at] == name, df[at], 0)
                front = n - -(-PARTS * n // 100) + 1
                order = np.lexsort((tokens, rank))[:front]
                share = np.float32((rank > 0).mean())
                for column, value in zip(
                    columns, (key, group, n, None, share, None), strict=True
                ):
                    if value is not None:
                        column.append(np.full(front, value))
                columns[3].append(np.arange(front))
                columns[5].append(tokens[order])
                often.append(rank[order])
            if not columns[0]:
                continue
            flat = [
                np.concatenate(c).astype(k) for c, k in zip(columns, _POSTING, strict=True)
            ]
            rows, lists = _units(flat[5], flat[0], np.concatenate(often), pairs, BLOCK_CLASSES)
            # A class of very many blocks' lists goes out in parts.
            for at in range(0, len(rows), PAIR_ROWS):
                some = slice(at, at + PAIR_ROWS)
                part = [c[rows[some]] for c in flat[:5]] + [lists[some]]
                home = (mixed(part[5]) % np.uint64(buckets)).astype(np.int64)
                yield _pack(home, part)

    return run


def token_names(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Tokens as they are called where they are counted: bucket and lower half."""
    name = (tokens >> np.uint64(32)) % np.uint64(buckets)
    return (name << np.uint64(32) | tokens & np.uint64(0xFFFFFFFF)).view(np.int64)


def _possible(n, i, m, j) -> np.ndarray:
    """Whether sets whose first common token stands at places i and j can be
    linked: what follows it must suffice."""
    n, i, m, j = (x.astype(np.int64) for x in (n, i, m, j))
    need = _need(n, m)
    return (np.minimum(n - i, m - j) >= need) & (np.minimum(n, m) >= need)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.Table:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.table({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])})


def _sorted_postings(table: pa.Table):
    key, group, n, place, share, token = _unpack(table, _POSTING)
    order = np.argsort(token, kind="stable")
    key, group, n, place, share, token = (
        x[order] for x in (key, group, n, place, share, token)
    )
    starts = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)))
    return key, group, n, place, share, starts, np.diff(np.append(starts, len(token)))


def _stars(table: pa.Table) -> pa.Table:
    """Each token's classes with the one of them that has most frequent tokens."""
    key, _, n, place, share, starts, sizes = _sorted_postings(table)
    run = np.repeat(np.arange(len(starts)), sizes)
    best = np.lexsort((key, -share, run))[starts]
    a, b = best[run], np.arange(len(key))
    keep = (a != b) & _possible(n[a], place[a], n, place)
    return _pairs(key[a[keep]], key[b[keep]])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All possible pairs of classes of different groups on a list, block by block.
    Those of the largest group on the list are not compared with each other."""
    table = pa.Table.from_batches(list(batches))
    key, group, n, place, _, starts, sizes = _sorted_postings(table)
    least = np.minimum.reduceat(group, starts)
    most = np.maximum.reduceat(group, starts)
    held, count = [], 0
    for r in np.flatnonzero(least != most).tolist():
        rows = np.arange(starts[r], starts[r] + sizes[r])
        names, counts = np.unique(group[rows], return_counts=True)
        others = rows[group[rows] != names[counts.argmax()]]
        step = max(1, PAIR_ROWS // len(rows))
        for at in range(0, len(others), step):
            a = np.repeat(others[at : at + step], len(rows))
            b = np.tile(rows, len(a) // len(rows))
            keep = (group[a] != group[b]) & _possible(n[a], place[a], n[b], place[b])
            held.append((key[a[keep]], key[b[keep]]))
            count += int(keep.sum())
            if count >= PAIR_ROWS:
                yield from _pairs(*map(np.concatenate, zip(*held, strict=True))).to_batches()
                held, count = [], 0
    if count:
        yield from _pairs(*map(np.concatenate, zip(*held, strict=True))).to_batches()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        get = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keep = []
        for x, y in zip(get["x"], get["y"], strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= PARTS * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([get["a"], get["b"]], ["a", "b"]).filter(
            pa.array(keep, pa.bool_())
        )


def _most_frequent(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and their df, by token: the highest classes of df that together hold
    at most MOST_FREQUENT tokens. Classes are counted first, so that no more rows
    than that leave the tasks."""
    level = F.floor(8 * F.log2("df"))
    classes = tokens.groupBy(level.alias("level")).count().collect()
    least, total = 0, sum(r["count"] for r in classes)
    for row in sorted(classes):
        if total <= MOST_FREQUENT:
            break
        total -= row["count"]
        least = row["level"] + 1
    rows = tokens.filter(level >= least).toPandas().sort_values("token")
    return rows["token"].to_numpy(np.int64), rows["df"].to_numpy(np.int64)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(_verify, "a bigint, b bigint")


def _candidates(sets: DataFrame, postings, reduce) -> DataFrame:
    packed = sets.select("key", "grp", "tokens").mapInArrow(postings, PACKED)
    pairs = packed.groupBy("bucket").applyInArrow(reduce, "a bigint, b bigint")
    return stage(pairs.distinct(), "pairs")


def _hot_tokens(rows: DataFrame, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, in order, that at least ``HOT_SAMPLED`` classes of one in ``share`` of the
    distinct texts have, and about how many classes in all. There are fewer of them
    than the tokens of the sample by that factor."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    some = rows.select(F.xxhash64(text).alias("h"), text.alias("_text"))
    # The text's hash decides, so all copies of a text are one.
    some = some.filter(F.pmod(F.xxhash64("h"), F.lit(share)) == 0)
    texts = some.groupBy("h").agg(F.first("_text").alias("_text"))
    sets = texts.select("_text").mapInArrow(_sampled_sets, "key bigint, tokens binary")
    tokens = sets.dropDuplicates(["key"]).select("tokens").mapInArrow(_unfold, "token bigint")
    hot = tokens.groupBy("token").count().filter(F.col("count") >= HOT_SAMPLED).toPandas()
    found = hot["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], hot["count"].to_numpy(np.int64)[order] * share


def _sampled_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rechunked(batches, "_text", CHUNK_BYTES):
        sets = [s for s in shingle_sets(text_column(batch, "_text")) if len(s)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([set_key(s) for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            ["key", "tokens"],
        )


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = [np.frombuffer(raw.as_buffer(), np.int64) for raw in batch.column(0)]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(flat))], ["token"])


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(quoted(text), F.lit("")))


def shingle_classes(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, hash of the text, key of its shingle set (null if the set is empty),
    size of the set."""
    rows = docs.select(
        quoted(doc).cast("bigint").alias("doc_id"),
        _text_hash(text).alias("h"),
        quoted(text).alias("_text"),
    )
    return rows.mapInArrow(_keys, "doc_id bigint, h bigint, key bigint, n bigint")


def _joined(docs: DataFrame, doc: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents with their classes, and the classes (_key) with their component,
    its smallest key, and component_id, its smallest doc_id."""
    classes = stage(shingle_classes(docs, doc, text), "shingle-classes")
    named = classes.filter("key is not null and doc_id is not null")
    total, texts = classes.agg(F.sum("n"), F.approx_count_distinct("h")).first()
    total = total or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_TOKENS))
    rows = docs.filter(quoted(doc).isNotNull()).select(
        quoted(doc).cast("bigint").alias("doc_id"), quoted(text).alias("_text")
    )
    hot, hot_df = _hot_tokens(rows, max(1, texts // SAMPLED_TEXTS))
    packed = rows.select("_text").mapInArrow(_token_rows(buckets, hot), PACKED)
    counted = stage(
        packed.groupBy("bucket").applyInArrow(_shared(buckets), PACKED), "shared-tokens"
    )
    similar = stage(
        counted.filter("bucket is not null")
        .groupBy("bucket")
        .applyInArrow(_enough, "key bigint"),
        "similar-classes",
    )
    frequent, df = _most_frequent(
        counted.filter("bucket is null")
        .select("packed")
        .mapInArrow(_unfold_frequent, "token bigint, df bigint")
    )
    frequent = np.concatenate([frequent, token_names(hot, buckets)])
    df, order = np.concatenate([df, hot_df]), np.argsort(frequent, kind="stable")
    frequent, df = frequent[order], df[order]
    # One document stands for a class.
    chosen = named.groupBy("key").agg(F.min("doc_id").alias("doc_id")).join(similar, "key")
    sets = stage(
        join_small(rows, stage(chosen, "chosen-documents"), ["doc_id"], "inner")
        .select("key", "_text")
        .mapInArrow(_sets, SETS)
        .dropDuplicates(["key"]),
        "shingle-sets",
    )
    fronts = sets.agg(F.sum(F.expr("n div 4 + 1"))).first()[0] or 0
    homes = max(LEAST_BUCKETS, -(-fronts // BUCKET_TOKENS))
    lists = [_postings(buckets, homes, frequent, df, pairs) for pairs in (False, True)]
    alone = sets.withColumn("grp", F.col("key"))
    first = _candidates(alone, lists[0], _stars)
    links = stage(_linked(first, sets), "links")
    groups = components(links, "groups").withColumnsRenamed(
        {"node": "key", "component": "grp"}
    )
    grouped = join_small(sets, groups, ["key"], "left").withColumn(
        "grp", F.coalesce("grp", "key")
    )
    second = _candidates(grouped, lists[1], _across).join(first, ["a", "b"], "left_anti")
    more = stage(_linked(second, sets), "links")
    # Groups are one node each by now.
    heads = components(links.unionAll(more), "components").withColumnsRenamed(
        {"node": "key"}
    )
    by_key = named.groupBy("key").agg(F.min("doc_id").alias("least"))
    placed = stage(
        by_key.join(heads, "key", "left").withColumn(
            "component", F.coalesce("component", "key")
        ),
        "class-components",
    )
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(smallest, "component").select(
        F.col("key").alias("_key"), "component", "component_id"
    )
    return classes, placed


def near_documents(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id.

    A null or empty text has an empty set and is linked with nothing; a text of
    fewer than five words is one shingle. Documents without doc_id are linked
    with nothing and have no component. Repeated doc_ids are documents of their
    own. Other columns are not read. An empty table gives no rows.
    """
    classes, placed = _joined(docs, doc, text)
    joined = classes.join(
        placed, (F.col("key") == F.col("_key")) & F.col("doc_id").isNotNull(), "left"
    )
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _heads(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc_id, h, many): the text that stays of each component, by smallest doc_id and
    then by its hash, whether rows repeat it, and the texts with an empty set."""
    classes, placed = _joined(docs, doc, text)
    named = classes.filter("doc_id is not null")
    counted = (
        named.join(placed, F.col("key") == F.col("_key"))
        .groupBy("component", "doc_id", "h")
        .agg((F.count(F.lit(1)) > 1).alias("many"))
    )
    heads = counted.groupBy("component").agg(F.min(F.struct("doc_id", "h", "many")).alias("x"))
    empty = named.filter("key is null").select("doc_id", "h", F.lit(False).alias("many"))
    return heads.select("x.*").unionAll(empty.distinct())


def one_of_each_group(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", repeated_ids: bool = False
) -> DataFrame:
    """The rows whose doc_id is the smallest of its group, and those linked with
    nothing, unchanged. Of rows that repeat a doc_id the one with the smallest
    text stays. Rows without doc_id all stay.

    With ``repeated_ids`` different texts of one doc_id are judged separately: one row
    of each group stays, by its smallest doc_id and then by a hash of the text, and
    every row linked with nothing."""
    if repeated_ids:
        own, same, many, row = (fresh_name(docs, c) for c in ("_kept", "_hash", "_many", "_row"))
        kept = _heads(docs, doc, text).toDF(own, same, many)
        rows = docs.join(
            broadcast_if_small(kept),
            (quoted(doc).cast("bigint") == F.col(own)) & (_text_hash(text) == F.col(same)),
        )
        return _first_rows(docs, rows, [own, same], many, row, doc, text)
    found = near_documents(docs, doc, text)
    own, many, row = (fresh_name(docs, c) for c in ("_kept", "_many", "_row"))
    kept = (
        found.filter("doc_id = component_id")
        .groupBy(F.col("doc_id").alias(own))
        .agg((F.count(F.lit(1)) > 1).alias(many))
    )
    # The join is on a narrow table, sent to the tasks if it measures small.
    rows = docs.join(broadcast_if_small(kept), quoted(doc) == F.col(own))
    return _first_rows(docs, rows, [own], many, row, doc, text)


def _first_rows(
    docs: DataFrame, rows: DataFrame, keys: list[str], many: str, row: str, doc: str, text: str
) -> DataFrame:
    """Of the rows that are many for their keys the one with the smallest text, the
    others, and the documents without doc_id."""
    first = Window.partitionBy(*keys).orderBy(quoted(text))
    repeated = rows.filter(F.col(many)).withColumn(row, F.row_number().over(first))
    columns = [quoted(c) for c in docs.columns]
    return (
        rows.filter(~F.col(many))
        .select(*columns)
        .unionAll(repeated.filter(F.col(row) == 1).select(*columns))
        .unionAll(docs.filter(quoted(doc).isNull()))
    )
