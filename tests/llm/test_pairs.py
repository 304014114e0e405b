"""Similarity joins, embeddings and fingerprints against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from prefshare.llm import common, embedding_dedup, fingerprint, ngram_join
from prefshare.llm.catalog import importable


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(i, i + 1) for i in range(500, 560)] + [(600, i) for i in range(601, 700)]
    edges = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in common.components(edges).collect()}
    nodes = {x for e in links for x in e if e[0] != e[1]}
    assert got == roots(nodes, [e for e in links if e[0] != e[1]])
    assert common.components(edges.limit(0)).count() == 0


def test_group_ranks(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_BUCKETS", 7)
    monkeypatch.setattr(common, "SUMMED_BUCKETS", 2)
    rows = [(7 if i % 3 else i % 2, i // 2, "x") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v int, _bucket string")
    from pyspark.sql import functions as F

    got = common.group_ranks(df, ["k"], [F.col("v")], "rank", 200).collect()
    by_key = collections.defaultdict(list)
    for r in got:
        by_key[r.k].append(r["rank"])
    assert {k: sorted(v) for k, v in by_key.items()} == {
        k: list(range(n)) for k, n in collections.Counter(r[0] for r in rows).items()
    }


def word_sets(texts):
    out = []
    for text in texts:
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall("[^\x20\x09-\x0d]+", lower)
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        out.append(frozenset(grams or ([tuple(words)] if words else [])))
    return out


def similar(sets):
    """Pairs of places with a Jaccard index of at least 0.75."""
    places = collections.defaultdict(list)
    out = []
    for i, s in enumerate(sets):
        common_ = collections.Counter(j for g in s for j in places[g])
        out += [(j, i) for j, k in common_.items() if 100 * k >= 75 * (len(s) + len(sets[j]) - k)]
        for g in s:
            places[g].append(i)
    return out


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("abcdefgh") + rng.choice("xyzw1É")
    return words


def near_texts(seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") + rng.choice("xyzw") for _ in range(rng.randint(5, 120))] for _ in range(25)]
    texts = []
    for i in range(450):
        words = edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3, 5, 9]))
        if rng.random() < 0.2:
            words += rng.choice(base)[:30]
        if rng.random() < 0.1:
            words = words[: rng.randint(0, 6)]
        texts.append("\t ".join(words).upper() if i % 9 == 0 else " ".join(words))
    # One large group of near copies and one of exact copies.
    long = [f"w{i}" for i in range(150)]
    texts += [" ".join(edited(rng, long, rng.randint(0, 5))) for _ in range(120)]
    texts += [" ".join(long)] * 80
    return texts + [None, "", "  ", "A b", "a B", "x " * 3000]


@pytest.mark.parametrize("seed, frequent, block", [(1, 16, 2048), (2, 2, 5), (3, 10**6, 2048), (4, 2, 3)])
def test_near_documents_lose_no_link(spark, monkeypatch, seed, frequent, block):
    """Also where frequent tokens' lists are cut in blocks, and with a sample of few texts
    whose hot tokens are counted apart."""
    importable(spark)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    if block < 2048:
        monkeypatch.setattr(ngram_join, "SAMPLED_TEXTS", 100)
        monkeypatch.setattr(ngram_join, "HOT_SAMPLED", 2)
    texts = near_texts(seed)
    ids = [i * 7 % 10_007 for i in range(len(texts))]
    rows = [(i, t, 1, "g") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept int, grp string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_documents(docs.repartition(5)).collect()}
    sets = word_sets(texts)
    links = [(ids[a], ids[b]) for a, b in similar(sets)]
    root = roots(ids, links)
    assert got == {i: (len(s), root[i]) for i, s in zip(ids, sets, strict=True)}
    if seed == 1:
        kept = ngram_join.one_of_each_group(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in ids if root[i] == i)


def test_texts_of_shared_lines(spark, monkeypatch):
    """Hot tokens throughout: texts are made of the same few lines."""
    importable(spark)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 64)
    rng = random.Random(8)
    lines = [" ".join(f"l{i}w{k}" for k in range(8)) for i in range(14)]
    texts = [" ".join(sorted(rng.sample(lines, rng.randint(6, 12)))) for _ in range(700)]
    texts += [" ".join([*sorted(rng.sample(lines, 9)), f"x{i} y{i}"]) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.near_documents(docs).collect()}
    links = similar(word_sets(texts))
    assert len(links) > 20 and got == roots(range(len(texts)), links)


def test_near_documents_odd_rows(spark):
    importable(spark)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other"), (None, "a b c d e f"), (3, "a b c d e f"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in ngram_join.near_documents(docs).collect())
    assert got == [(0, 2, 0), (1, 1, 1), (1, 2, 1), (1, 2, 1), (3, 2, 1), (4, 0, 4)]
    kept = sorted((r.doc_id or 0, r.text or "") for r in ngram_join.one_of_each_group(docs).collect())
    assert kept == [(0, "a b c d e f"), (1, "a b c d e f"), (4, "")]
    assert ngram_join.near_documents(docs.limit(0)).count() == 0
    assert ngram_join.one_of_each_group(docs.limit(0)).count() == 0


def test_frequent_tokens_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", 10)
    rows = [(i, 20 * (1 + i % 5) ** 2) for i in range(40)]
    tokens, df = ngram_join._most_frequent(spark.createDataFrame(rows, "token long, df long"))
    assert len(tokens) == 8 and set(df) == {500}


def vectors(seed, dimension=48):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(60, dimension))
    out = list(rng.normal(size=(200, dimension)))
    for c in centres:
        for _ in range(rng.integers(1, 9)):
            v = c / np.linalg.norm(c) + rng.normal(size=dimension) * rng.uniform(0, 0.4) / dimension**0.5
            out.append(v * rng.uniform(0.5, 3))
    out += [out[5]] * 40 + [out[6] * 2]
    return [v.astype(np.float32).tolist() for v in out]


def brute_cosines(rows):
    good = [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[i] for i in good], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    return [(good[i], good[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]


@pytest.mark.parametrize("block, few", [(2048, 32), (16, 32), (16, 3)])
def test_near_vectors(spark, monkeypatch, block, few):
    """Also where keys of many vectors are cut, and where few groups are compared together."""
    importable(spark)
    monkeypatch.setattr(embedding_dedup, "FEW_ROWS", few)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block)
    rows = vectors(block) + [None, [], [0.0] * 48, [float("nan")] * 48, [None] * 48]
    ids = [(i * 13) % 4099 for i in range(len(rows))]
    data = [(i, v, 1, "k") for i, v in zip(ids, rows, strict=True)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, rep int, `key` string")
    # With buckets of 16 the keys must be shared by many.
    shape = embedding_dedup.Tables(1, 8, 1) if block == 16 else None
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, shape=shape).collect()}
    assert len(got) == len(rows)
    links = [(ids[a], ids[b]) for a, b in brute_cosines(rows)]
    count = collections.Counter(x for e in links for x in e)
    assert all(got[i].n_links <= count[i] for i in ids)
    found = sum(r.n_links for r in got.values())
    assert found >= 0.98 * 2 * len(links)
    if found == 2 * len(links):
        root = roots(ids, links)
        assert all(got[i].component_id == root[i] and got[i].kept == (root[i] == i) for i in ids)


def test_near_vectors_odd_rows(spark):
    importable(spark)
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup.near_vectors(df).collect())
    assert got == [
        (0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True),
    ]
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_size_are_compared(spark):
    importable(spark)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    rows = [(i, (v * s).tolist()) for i, v in enumerate(base) for s in (1e250, 1e-250, 1.0)]
    data = [(100 * k + i, v) for k, (i, v) in enumerate(rows)]
    data += [(90_001, [float("inf")] * 16), (90_002, [1e300] * 15 + [float("nan")])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df).collect()}
    for at in range(0, len(rows), 3):
        ids = [data[at + k][0] for k in range(3)]
        assert all(got[i].n_links >= 2 and got[i].component_id <= ids[0] for i in ids)
    assert all(got[i].n_links == 0 and got[i].kept for i in (90_001, 90_002))


def test_hadamard_is_orthogonal():
    h = embedding_dedup.hadamard(np.eye(16)) / 4
    assert np.allclose(h @ h.T, np.eye(16))


def test_fingerprints(spark, capsys):
    rng = random.Random(9)
    words = ["w" + c + d for c in "abcdefghij" for d in "klmnopqrst"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + "." for _ in range(120)]
    texts += [None, "", "é" * 9, texts[0]]
    ids = [3 * i for i in range(len(texts))]
    rows = [(i, t, "f", 1) for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, h int")
    frame = fingerprint.fingerprint_documents(docs.repartition(4), band=(0.5, 4.0))
    got = {r.doc_id: r for r in frame.collect()}
    whole = [t or "" for t in texts]
    for k, (i, text) in enumerate(zip(ids, whole, strict=True)):
        n = len(text)
        after = whole[(k + 1) % len(whole)]
        changed = text[: n - n // 4] + after[: n // 4]
        assert got[i].n_chars == n
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    # The lexicon and the distinct sorted terms decide.
    terms = [set(filter(None, re.split(r"[\W_]+", t.lower()))) for t in whole]
    df = collections.Counter(t for s in terms for t in s)
    low, high = len(whole) * np.exp(-4.0), len(whole) * np.exp(-0.5)
    known = {t for t, n in df.items() if low <= n <= high}
    by_terms = collections.defaultdict(set)
    for i, s in zip(ids, terms, strict=True):
        by_terms[frozenset(s & known)].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_terms.values())
    assert got[ids[0]].fingerprint == got[ids[-1]].fingerprint
    firsts = {s: next(iter(v)).split(":")[0] for s, v in by_terms.items() if s}
    assert len(set(firsts.values())) == len(firsts)
    for k, i in enumerate(ids):
        mine, other = (got[j].fingerprint.split(":") for j in (i, ids[(k + 1) % len(ids)]))
        edit = got[i].edited_fingerprint.split(":")
        for theirs, value in ((edit, got[i].near_edited), (other, got[i].near_next)):
            either = [(a, b) for a, b in zip(mine, theirs, strict=True) if {a, b} != {"-"}]
            same = sum(a == b for a, b in either)
            assert value == (same / len(either) if either else 1)
    frame.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_fingerprints_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d")], "doc_id long, text string")
    got = fingerprint.fingerprint_documents(docs, band=(0.0, 9.0)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 1), (1, 3), (1, 3)]
    assert fingerprint.fingerprint_documents(docs.limit(0)).count() == 0


def test_fingerprints_of_hot_copies(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.sample(words, 40)) for _ in range(100)]
    alone = fingerprint.fingerprint_documents(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    )
    hot = texts + [texts[7]] * 50
    copied = fingerprint.fingerprint_documents(
        spark.createDataFrame(list(enumerate(hot)), "doc_id long, text string")
    )
    before = {r.doc_id: r.fingerprint for r in alone.collect()}
    after = {r.doc_id: r for r in copied.collect()}
    assert all(after[i].fingerprint == before[i] for i in before)
    assert all(after[i].fingerprint == before[7] for i in range(100, 150))
    assert set(before[7]) - set(":-") and all(after[i].near_next == 1 for i in range(100, 149))


def test_fingerprints_without_lexicon_terms(spark):
    # Terms in every text, and terms in one text only, are outside of the band.
    rows = [(i, f"common words {i // 3}") for i in range(9)] + [(9, "common words"), (10, "words common"), (11, "."), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(docs, band=(1.0, 1.1), whole_terms=True).collect()}
    assert len(got) == len(rows)
    empty = ":".join("-" * fingerprint.SUBSETS)
    assert got[11].fingerprint == got[12].fingerprint == empty
    prints = [got[i].fingerprint for i in range(11)]
    assert empty not in prints and len(set(prints)) == 4
    assert prints[0] == prints[2] and prints[9] == prints[10]
    assert [got[i].near_next for i in (0, 1, 9)] == [1, 1, 1]


def test_equal_fingerprints_are_alike(spark):
    """Also where a text has no term at all."""
    rows = [(1, "...!"), (2, "...!"), (3, "-"), (4, ""), (5, "one two three four"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(docs, whole_terms=True).collect()}
    for i in (1, 2, 3, 4):
        assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1
    assert got[1].near_next == got[2].near_next == 1
    assert got[5].near_next == got[4].near_next == 0


def test_fingerprints_by_shuffle_joins(spark, settings, monkeypatch):
    """The same rows where no side may be broadcast, and with a very long text."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(90)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(60)] + ["!", None]
    texts += [" ".join(rng.choices(words, k=60_000))] + texts[:20]
    rows = [(i % 70, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def found():
        frame = fingerprint.fingerprint_documents(docs, band=(0.3, 5.0), whole_terms=True)
        return frame, sorted(tuple(r) for r in frame.collect())

    _, want = found()
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(common, "broadcast_if_small", lambda df, *_: df)
    frame, got = found()
    assert got == want and len(got) == len(rows)


def pairs_at(cosine, count, dimension, seed):
    rng = np.random.default_rng(seed)
    x, z = (embedding_dedup.unit_rows(list(rng.normal(size=(count, dimension)))) for _ in range(2))
    z = embedding_dedup.unit_rows(list(z - (x * z).sum(axis=1, keepdims=True) * x))
    return x, cosine * x + (1 - cosine**2) ** 0.5 * z


@pytest.mark.parametrize("rows, axes, dimension", [(10**6, 3, 64), (10**8, 4, 64), (10**7, 3, 128), (10**9, 4, 128)])
def test_tables_find_pairs_at_the_threshold(rows, axes, dimension):
    shape = embedding_dedup.Tables.sized(rows, dimension)
    assert shape.axes == axes
    for cosine in (0.9, 0.91, 0.92):
        x, y = pairs_at(cosine, 1500, dimension, 5)
        mine, theirs = (embedding_dedup.keys_of(v, shape) for v in (x, y))
        met = (mine[..., :, None] == theirs[..., None, :]).any(axis=(1, 2, 3))
        assert met.mean() >= 0.983


def test_every_verified_pair_counts_once():
    shape = embedding_dedup.Tables(3, 4, 3)
    x, y = pairs_at(0.9, 400, 64, 6)
    counted = set()
    for k, (a, b) in enumerate(zip(x, y, strict=True)):
        keys = embedding_dedup.keys_of(np.array([a, b]), shape).reshape(2, -1)
        links = 0
        for key in set(keys[0].tolist()) & set(keys[1].tolist()):
            group = {
                "vector": [(v * 1.0000001).tobytes() for v in (a, b)], "rep": [0, 1], "weight": [1, 1],
                "keys": keys.tolist(), "block": [0, 0], "key": [key] * 2, "lo": [0, 0], "hi": [0, 0],
            }
            counts, stars = embedding_dedup._compare(group, np.array([0]), np.array([2]), 0.8999, np.float64)
            assert stars.tolist() == [[1, 0]]
            links += len(counts) // 2
        common_ = bool(set(keys[0].tolist()) & set(keys[1].tolist()))
        assert links == common_
        counted.add(links)
    assert counted == {0, 1}


@pytest.mark.parametrize("few", [32, 1])
def test_vectors_of_two_lengths_under_one_key(monkeypatch, few):
    """A clash of hashes brings them together; they are not alike."""
    monkeypatch.setattr(embedding_dedup, "FEW_ROWS", few)
    values = [[1.0, 0.0], [1.0, 0.0, 0.0], [2.0, 0.1], [1.0, 0.1, 0.0]]
    group = {
        "vector": [np.array(v).tobytes() for v in values], "rep": [5, 6, 7, 8], "weight": [1, 1, 3, 1],
        "keys": [[9]] * 4, "block": [0] * 4, "key": [9] * 4, "lo": [0] * 4, "hi": [0] * 4,
    }
    counts, stars = embedding_dedup._compare(group, np.array([0]), np.array([4]), 0.9, np.float64)
    assert counts.tolist() == [[5, 3], [6, 1], [7, 1], [8, 1]]
    assert stars.tolist() == [[7, 5], [8, 6]]
