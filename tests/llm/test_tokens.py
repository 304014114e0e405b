"""Words, token ids, token files and packing."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from prefshare.llm import binary, packing
from prefshare.llm.catalog import importable
from prefshare.llm.tokens import WordEncoder, default_tokenizer
from prefshare.llm.words import words_of
from prefshare.sources.scratch import scratch_path

PATH = default_tokenizer()
ODD = [
    "", " ", "a b", "x\x1cy", "<|endoftext|> don't I'LL", "é ́a  12345 \x0b\x0cq",
    "ΣΑΣ Σ", "a. b, c.d ,", "».", " é. É,", "...", "a " * 5000, "ab" * 3000, "日本 語",
]
DOCS = (
    "doc_id bigint, text string, start string, _row int, _text string, N_Tokens int, "
    "piece string, sequence_id string, _rank string, length string"
)


OWN, LIBRARY = WordEncoder(PATH), Tokenizer.from_file(PATH)


def documents(spark, texts, ids=None):
    importable(spark)
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "s", 1, "t", 2, "p", "q", "r", "l") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab.,' \n\tÉß1@́　", max_size=30), max_size=6))
def test_words_are_those_between_ascii_white_space(texts):
    words = words_of(pa.array(texts, pa.large_string()), lower=True)
    found = [
        [words.text(i) for i in range(a, b)]
        for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)
    ]
    lower = [t.translate({c: c + 32 for c in range(65, 91)}) for t in texts]
    assert found == [[w for w in t.replace("\n", " ").replace("\t", " ").split(" ") if w] for t in lower]
    same = {}
    for word, h in zip([w for t in found for w in t], words.hashes().tolist(), strict=True):
        assert same.setdefault(word, h) == h
    assert len(set(same.values())) == len(same)


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abT.,'s \nÉß1@<|>́　", max_size=40), max_size=5))
def test_ids_are_the_library_s(texts):
    for some in (texts, texts[::-1]):  # the second time from kept words
        ids, ends = OWN.encode(pa.array(some, pa.large_string()))
        parts = np.split(ids, ends[:-1]) if some else []
        assert [p.tolist() for p in parts] == [
            LIBRARY.encode(t, add_special_tokens=False).ids for t in some
        ]


@hypothesis_settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500))
def test_codes_round_trip_and_random_access(ids):
    codes = binary.DirectCodes.from_bytes(binary.DirectCodes.of(np.array(ids, np.uint32)).to_bytes())
    assert codes.decode().tolist() == ids and len(codes) == len(ids)
    for i in random.Random(1).sample(range(len(ids)), min(20, len(ids))):
        assert codes[i] == ids[i]
    with pytest.raises(IndexError):
        codes[len(ids)]


def test_random_access_over_rank_blocks():
    ids = np.random.default_rng(3).integers(0, 49_000, 5000).astype(np.uint32)
    ids[::3] %= 256
    codes = binary.DirectCodes.of(ids)
    assert [codes[i] for i in range(0, 5000, 37)] == ids[::37].tolist()


def test_token_files(spark):
    texts = [*ODD, None, "same", "same"]
    ids = [*range(len(ODD) - 1, -1, -1), 100, 101, 101]
    path = scratch_path(spark, "tokens")
    binary.write_tokens(documents(spark, texts, ids).repartition(3), path, PATH, segment_tokens=500)
    rows = binary.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted(ids)
    stream = []
    by_id = dict(zip(ids, texts, strict=True))
    for r in rows:
        own = [*LIBRARY.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens) == (len(stream), len(own))
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4"))
        stream += own
    for at in (0, 1, 700, len(stream) - 1):
        assert binary.token_at(spark, path, at) == stream[at]
    assert binary.token_at(spark, path, len(stream)) is None


def test_token_files_of_nothing(spark):
    path = scratch_path(spark, "tokens")
    binary.write_tokens(documents(spark, []), path, PATH)
    assert binary.read_tokens(spark, path).count() == 0
    assert binary.token_at(spark, path, 0) is None


@hypothesis_settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=8), st.integers(1, 60))
def test_fullest_is_the_best_subset(counts, capacity):
    used = packing.fullest(counts, capacity)
    assert all(counts[x] >= n > 0 for x, n in used.items())
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= capacity}
    assert sum(x * n for x, n in used.items()) == max(sums)


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 300), max_size=12))
def test_patterns_use_up_the_lengths(histogram):
    patterns = packing.minimum_slack(histogram, 32)
    left = dict.fromkeys(histogram, 0)
    first = 0
    for p in patterns:
        assert p.first == first and sum(x * n for x, n in p.lengths.items()) <= 32
        first += p.times
        for x, n in p.lengths.items():
            left[x] += n * p.times
    assert left == histogram
    total = sum(x * n for x, n in histogram.items())
    assert -(-total // 32) <= first <= sum(histogram.values())


def test_packing(spark):
    rng = random.Random(5)
    texts = [" ".join("the of and".split() * rng.randint(0, 30)) for _ in range(120)]
    texts += [*ODD, None, "copy", "copy"]
    ids = [*range(len(texts) - 1), len(texts) - 2]  # the last two rows are equal
    docs = documents(spark, texts, ids)
    rows = packing.pack_documents(docs, PATH, capacity=64).collect()
    expected = []
    for i, text in zip(ids, texts, strict=True):
        own = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(own), 64)):
            part = own[start : start + 64]
            expected.append((i, piece, start, len(part), zlib.crc32(part)))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(expected)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 64) + 1
    assert packing.pack_documents(documents(spark, []), PATH).count() == 0


def test_packing_in_file_order(spark):
    texts = ["one two three " * (1 + i % 7) for i in range(60)]
    path = scratch_path(spark, "documents")
    written = documents(spark, texts).select("doc_id", "text").repartition(1)
    written.sortWithinPartitions("doc_id").write.parquet(path)
    docs = spark.read.parquet(path)
    rows = packing.pack_documents(docs, PATH, capacity=16, file_order=True).collect()
    leads = sorted((r.sequence_id, r.doc_id, r.piece) for r in rows if r.offset == 0)
    assert [x[0] for x in leads] == list(range(len(leads)))
    assert [x[1:] for x in leads] == sorted(x[1:] for x in leads)
    plain = packing.pack_documents(docs, PATH, capacity=16).collect()
    assert {r.sequence_id for r in plain} == {r.sequence_id for r in rows}
