"""Near duplicates among embeddings by cross-polytope hashing.

A fast rotation (three rounds of random signs and a Hadamard transform) takes a
vector to the closest axis of the cross-polytope, by the largest absolute value
and its sign. A table joins the axes of several rotations in one key; besides its
own key a vector probes the keys in which one axis is the second closest. Vectors
that meet under a key are compared in double precision.

Equal vectors are one class and are hashed once. Keys are shuffled by themselves
first, with the class's id. There are more keys than vectors, so unrelated vectors
seldom meet and most keys have one vector; only the keys that several vectors have
are then given their vectors.

A pair may meet several times; it counts under the first key that both have, own or
probed, so links are counted without a list of pairs. For the components a task gives
each set of linked vectors as a star. A key that holds many vectors is cut in blocks,
and each two blocks are compared in a group of their own.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefshare.functions.flags import quoted
from prefshare.llm.common import components, join_small, ragged
from prefshare.llm.words import mixed
from prefshare.sources.scratch import stage

SEED = 20240601
BLOCK_ROWS = 2048
# Pairs whose keys or vectors are held at once.
PAIR_ROWS = 1 << 15
# Groups of so few rows are compared together.
FEW_ROWS = 32
# Pairs and tables of the trial that sizes the tables.
TRIAL = 256, 16
ROUNDS = 3
# A key's table stands above so many bits of its hash, and tables count modulo 256.
KEY_BITS, BANDS = 55, 256
SIGNATURE = "rep bigint, weight bigint, vector binary, keys array<bigint>"
FOUND = "a bigint, b bigint, n bigint"


@dataclass(frozen=True)
class Tables:
    """Rotations of a table, tables, and probes of a table besides the own key."""

    axes: int
    tables: int
    probes: int

    @staticmethod
    def sized(rows: int, dimension: int, miss: float = 0.01, least: float = 0.9) -> Tables:
        """At least as many keys as vectors, so that few unrelated ones meet, and tables
        so many that a pair at the threshold is missed with about that chance."""
        width = 2 * max(2, dimension)
        axes = max(2, math.ceil(math.log(max(rows, 2)) / math.log(width)))
        together = Tables.together(axes, max(2, dimension), least)
        return Tables(axes, math.ceil(math.log(miss) / math.log(1 - together)), axes)

    @staticmethod
    def together(axes: int, dimension: int, least: float) -> float:
        """The chance that two vectors of that cosine share a key of a table, own or
        probed, from random pairs."""
        pairs, tables = TRIAL
        rng = np.random.default_rng([SEED, dimension, axes])
        x, z = unit_rows(rng.normal(size=(2 * pairs, dimension))).reshape(2, pairs, dimension)
        z = unit_rows(z - (x * z).sum(axis=1, keepdims=True) * x)
        y = least * x + math.sqrt(max(0.0, 1 - least * least)) * z
        shape = Tables(axes, tables, axes)
        mine, theirs = keys_of(x, shape), keys_of(y, shape)
        share = (mine[..., :, None] == theirs[..., None, :]).any(axis=(2, 3)).mean()
        return min(max(float(share), 1 / (pairs * tables)), 1 - 1e-9)


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of length one, of vectors of any finite size that are not zero."""
    rows = np.array(vectors, np.float64)
    # The largest component becomes one, so that no square is too large or too small. A
    # power of two leaves the other components' digits as they are.
    top = np.abs(rows).max(axis=1, initial=0.0, keepdims=True)
    rows = np.ldexp(rows, 1 - np.frexp(top)[1])
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    step = 1
    while step < x.shape[1]:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
        x = x.reshape(len(x), -1)
        step *= 2
    return x


def keys_of(x: np.ndarray, shape: Tables) -> np.ndarray:
    """Keys (rows x tables x 1 + probes), above zero; the first of a table is the own key."""
    count, dimension = x.shape
    padded = 1 << max(1, (dimension - 1).bit_length())
    base = np.zeros((count, padded))
    base[:, :dimension] = x
    out = np.empty((count, shape.tables, 1 + shape.probes), np.uint64)
    at = np.arange(count)
    for t in range(shape.tables):
        closest = np.empty((count, shape.axes, 2), np.uint64)
        gap = np.empty((count, shape.axes))
        for k in range(shape.axes):
            rng = np.random.default_rng([SEED, dimension, t, k])
            y = base
            for _ in range(ROUNDS):
                y = hadamard(y * rng.choice([-1.0, 1.0], padded)) / math.sqrt(padded)
            size = np.abs(y)
            two = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = size[at, two[:, 0]] < size[at, two[:, 1]]
            two[swap] = two[swap][:, ::-1]
            for i in (0, 1):
                closest[:, k, i] = two[:, i] * 2 + (y[at, two[:, i]] > 0)
            gap[:, k] = size[at, two[:, 0]] - size[at, two[:, 1]]
        order = np.argsort(gap, axis=1, kind="stable")
        for probe in range(1 + shape.probes):
            key = np.full(count, dimension * 1009 + t + 1, np.uint64)
            for k in range(shape.axes):
                second = (order[:, probe - 1] == k).astype(int) if probe else 0
                axis = closest[at, k, second]
                key = mixed(key * np.uint64(1_000_003) + axis + np.uint64(1))
            band = np.uint64(t % BANDS << KEY_BITS)
            out[:, t, probe] = key >> np.uint64(64 - KEY_BITS) | band
    return out.view(np.int64)


def _sign(shape: Tables, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, weights, lists = (batch.column(i) for i in range(3))
            vectors = [np.array(v, np.float64) for v in lists.to_pylist()]
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for rows in by_size.values():
                x = unit_rows([vectors[i] for i in rows])
                keys = keys_of(x, shape).reshape(len(rows), -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        reps.take(pa.array(rows)),
                        weights.take(pa.array(rows)),
                        pa.array([vectors[i].astype(kind).tobytes() for i in rows], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    ["rep", "weight", "vector", "keys"],
                )

    return run


def _labels(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each row is linked with, over any number of steps."""
    label = np.arange(count)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _by_band(keys: list[list[int]], pad: int) -> np.ndarray:
    """Rows x bands x places; the keys of each row by the band they are of, then ``pad``."""
    sizes = np.array([len(k) for k in keys])
    flat = np.array([x for k in keys for x in sorted(k)], np.int64)
    cell = np.repeat(np.arange(len(keys)), sizes) * BANDS + (flat >> KEY_BITS)
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    place = np.arange(len(flat)) - np.repeat(starts, np.diff(starts, append=len(flat)))
    bands, column = np.unique(flat >> KEY_BITS, return_inverse=True)
    out = np.full((len(keys), len(bands), int(place.max()) + 1), pad, np.int64)
    out[cell // BANDS, column, place] = flat
    return out


def _first_met(mine: np.ndarray, theirs: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the key is the smallest one that the rows have in common."""
    first = np.ones(len(mine), bool)
    for band in range(mine.shape[1]):
        a, b = mine[:, band], theirs[:, band]
        same = (a[:, :, None] == b[:, None, :]).any(axis=2)
        first &= ~(same & (a < key[:, None])).any(axis=1)
    return first


def _unit_vectors(group: dict, kind: type) -> np.ndarray:
    """Rows of length one. Should a key's hash hold vectors of several lengths, each
    length stands in columns of its own, so that their cosines are zero."""
    vectors = [np.frombuffer(v, kind) for v in group["vector"]]
    sizes = np.array([len(v) for v in vectors])
    out = np.zeros((len(vectors), int(np.unique(sizes).sum())))
    at = 0
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        out[rows, at : at + size] = unit_rows([vectors[r] for r in rows])
        at += size
    return out


def _near_in_large(group: dict, least: float, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of rows of one group whose cosine is at least so large."""
    x = _unit_vectors(group, kind)
    near = x @ x.T >= least
    if group["lo"][0] != group["hi"][0]:
        block = np.array(group["block"])
        near &= block[:, None] != block[None, :]
    return np.nonzero(np.triu(near, 1))


def _near_in_few(
    group: dict, starts: np.ndarray, sizes: np.ndarray, least: float, kind: type
) -> tuple[np.ndarray, np.ndarray]:
    """The same of many groups, which are given by their first rows and sizes."""
    x = _unit_vectors(group, kind)
    block = np.array(group["block"])
    cut = np.array(group["lo"]) != np.array(group["hi"])
    found = [np.empty((2, 0), np.int64)]
    for size in np.unique(sizes).tolist():
        first, second = np.triu_indices(size, 1)
        of = starts[sizes == size][:, None]
        i, j = (of + first).ravel(), (of + second).ravel()
        for at in range(0, len(i), PAIR_ROWS):
            a, b = i[at : at + PAIR_ROWS], j[at : at + PAIR_ROWS]
            near = np.einsum("ij,ij->i", x[a], x[b]) >= least
            near &= ~cut[a] | (block[a] != block[b])
            found.append(np.stack([a[near], b[near]]))
    return tuple(np.concatenate(found, axis=1))


def _links(group: dict, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, n) of link counts and (a, b) of stars, from the near pairs."""
    rep, weight = np.array(group["rep"]), np.array(group["weight"])
    label = _labels(len(rep), i, j)
    ends = np.flatnonzero(label != np.arange(len(rep)))
    linked = np.zeros(len(rep), bool)
    linked[i] = linked[j] = True
    used, place = np.flatnonzero(linked), np.cumsum(linked) - 1
    links = np.zeros(len(rep))
    if len(used):
        keys = [group["keys"][u] for u in used]
        # The two sides' empty places differ, so that they are not taken as common.
        mine, theirs = _by_band(keys, -1), _by_band(keys, -2)
        key = np.array(group["key"], np.int64)
        counts = np.zeros(len(i), bool)
        for at in range(0, len(i), PAIR_ROWS):
            part = slice(at, at + PAIR_ROWS)
            a, b = place[i[part]], place[j[part]]
            counts[part] = _first_met(mine[a], theirs[b], key[i[part]])
        i, j = i[counts], j[counts]
        links = np.bincount(i, weight[j], len(rep)) + np.bincount(j, weight[i], len(rep))
    some = np.flatnonzero(links)
    return (
        np.stack([rep[some], links[some].astype(np.int64)], 1),
        np.stack([rep[ends], rep[label[ends]]], 1),
    )


def _compare(
    group: dict, starts: np.ndarray, sizes: np.ndarray, least: float, kind: type
) -> tuple[np.ndarray, np.ndarray]:
    """Link counts and stars of groups of few rows, or of one group of any size."""
    if len(sizes) == 1 and sizes[0] > FEW_ROWS:
        return _links(group, *_near_in_large(group, least, kind))
    return _links(group, *_near_in_few(group, starts, sizes, least, kind))


def _meet(least: float, kind: type):
    names = ["key", "lo", "hi"]
    read = [*names, "block", "rep", "weight", "vector", "keys"]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list, list]]:
        """Whole groups (key, lo, hi), whose rows arrive sorted: those of few rows
        together, with their first rows and sizes, and each other one by itself."""
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None:
                return
            ids = np.stack([held[c].to_numpy() for c in names], 1)
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            edges = np.concatenate([[0], cuts, [len(ids)] if batch is None else []]).astype(int)
            starts, sizes = edges[:-1], np.diff(edges)
            few = (sizes > 1) & (sizes <= FEW_ROWS)
            if few.any():
                yield held.slice(0, edges[-1]), starts[few], sizes[few]
            for at, size in zip(starts[sizes > FEW_ROWS], sizes[sizes > FEW_ROWS], strict=True):
                yield held.slice(at, size), np.array([0]), np.array([size])
            held = held.slice(edges[-1]).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in groups(batches):
            rows = ragged(starts, sizes)
            part = table.take(pa.array(rows))
            group = {c: part[c].to_pylist() for c in read}
            counts, stars = _compare(group, np.cumsum(sizes) - sizes, sizes, least, kind)
            if len(counts) or len(stars):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([counts[:, 0], stars[:, 0]])),
                        pa.array([None] * len(counts) + stars[:, 1].tolist(), pa.int64()),
                        pa.array(counts[:, 1].tolist() + [None] * len(stars), pa.int64()),
                    ],
                    ["a", "b", "n"],
                )

    return run


def near_vectors(
    df: DataFrame,
    least: float = 0.9,
    vec: str = "vec_id",
    embedding: str = "embedding",
    shape: Tables | None = None,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors without vec_id, link with nothing; so do vectors of different
    lengths. Repeated rows are vectors of their own, linked with each other.
    Other columns are not read. An empty table gives no rows.
    """
    # Components travel as they are stored and are compared as doubles.
    stored = df.select(quoted(embedding)).schema[0].dataType.elementType
    kind = np.float32 if isinstance(stored, T.FloatType) else np.float64
    value = F.transform(quoted(embedding), lambda x: x.cast("double"))
    rows = df.select(quoted(vec).cast("bigint").alias("vec_id"), value.alias("v"))
    good = (
        F.col("vec_id").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    # 128 bits of hash stand for the vector; null keys are joined with nothing.
    keyed = rows.select(
        "vec_id",
        "v",
        *[
            F.when(good, F.xxhash64(F.lit(i), "v")).alias(f"h{i}")
            for i in (1, 2)
        ],
    )
    classes = (
        keyed.filter("h1 is not null")
        .groupBy("h1", "h2")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("weight"),
            F.first("v").alias("v"),
        )
    )
    classes = stage(classes, "vector-classes")
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    shape = shape or Tables.sized(size["n"], size["d"] or 2, least=least)
    signed = stage(
        classes.select("rep", "weight", "v").mapInArrow(_sign(shape, kind), SIGNATURE),
        "vector-keys",
    )
    keys = signed.select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")
    # Written, so that a key of very many vectors can be split where it is joined.
    counted = stage(counted.select("key", blocks), "shared-keys")
    shared = join_small(keys, counted, ["key"], "inner").groupBy("rep").agg(
        F.collect_list(F.struct("key", "blocks")).alias("met")
    )
    met = shared.join(signed.select("rep", "weight", "vector"), "rep").select(
        "rep", "weight", "vector", F.col("met.key").alias("keys"), F.expr("inline(met)")
    )
    placed = met.withColumn(
        "block", F.expr("cast(pmod(xxhash64(rep), blocks) as int)")
    )
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key",
        F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"),
        "block",
        "rep",
        "weight",
        "vector",
        "keys",
    )
    together = placed.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = stage(together.mapInArrow(_meet(least, kind), FOUND), "vector-links")
    links = found.filter("n is not null").groupBy("a").agg(F.sum("n").alias("links"))
    joined = components(found.filter("b is not null").select("a", "b"), "vector-components")
    by_class = (
        classes.select("h1", "h2", "rep", "weight")
        .join(links.withColumnRenamed("a", "rep"), "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "h1",
            "h2",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return keyed.drop("v").join(by_class, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
