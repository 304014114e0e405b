"""Spelling variants: words that differ by one character, grouped under the frequent form.

A block of words is indexed by bit slices: for each position and letter a bitset over the
block's words that have the letter there. A query word runs through its letters once, for
all words of the block at the same time, and keeps

    Z  words that agree with the query so far,
    S  words with one letter replaced so far,
    I  words with one letter more: their slices are read one position further on,
    D  words with one letter less: their slices are read one position before.

Words of a block are in order of falling frequency, so the lowest bit of a result is the
most frequent near word and its number of bits is the number of near words: no pairs are
listed.

Near words meet in a block by halves. Of two near words, L being the smaller length,
either the first L // 2 letters are equal or the last L - L // 2. So a word goes to the
classes of its length and of the length below it, to each by its front and by its back
half. A pair is found in one class; its front block counts it if the front halves agree (Z
after L // 2 letters says so), else its back block does.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import join_small, rechunked, text_column
from prefshare.sources.scratch import stage

# The runs of letters that may be words once A to Z are folded.
LETTERS = "a-zÀ-ÿ"
DELETED_OF = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5

CHUNK_BYTES = 4 << 20
# Words of a block, fewer where they are long; queries that run at once.
BLOCK_WORDS = 8192
BLOCK_LETTERS = 1 << 20
QUERIES = 256


def word_counts(ids: list[str], texts: list[str], least: int) -> Counter:
    """Occurrences of the words of at least so many letters in the texts, each run
    having lost a letter where its hash says so."""
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    total: Counter = Counter()
    for doc, text in zip(ids, texts, strict=True):
        own = Counter(runs.findall(text.encode().lower().decode()))
        head = zlib.crc32(f"{doc}:".encode())
        for run, n in own.items():
            h = zlib.crc32(run.encode(), head)
            if h % DELETED_OF == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < least:
                    continue
            total[run] += n
    return total


def _counted(least: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            ids = ["" if i is None else i for i in batch.column(0).to_pylist()]
            found = word_counts(ids, text_column(batch, "_text").to_pylist(), least)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                ["word", "n"],
            )

    return run


def vocabulary(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """Rows (word, n) of the texts; tasks count before they shuffle."""
    rows = docs.select(
        quoted(doc).cast("string").alias("_doc"), quoted(text).alias("_text")
    )
    counted = rows.mapInArrow(_counted(least_letters), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class BitSlices:
    """Bitsets over the words of a block, one for each position and letter that occur;
    words are rows of code points, padded with zeros."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.width = -(-len(codes) // 64)
        self.lengths = lengths
        word, position = np.nonzero(codes)
        slots = position.astype(np.int64) << 32 | codes[word, position]
        self.slots, row = np.unique(slots, return_inverse=True)
        # The last row is the empty bitset.
        self.bits = np.zeros((len(self.slots) + 1, self.width), np.uint64)
        np.bitwise_or.at(
            self.bits, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64)
        )

    def rows(self, letters: np.ndarray, position: int) -> np.ndarray:
        """For each letter the bitset of the words that have it at the position."""
        want = np.int64(position) << 32 | letters.astype(np.int64)
        at = np.searchsorted(self.slots, want)
        hit = (at < len(self.slots)) & (position >= 0)
        hit[hit] = self.slots[at[hit]] == want[hit]
        return self.bits[np.where(hit, at, len(self.slots))]

    def of_length(self, length: int) -> np.ndarray:
        word = np.flatnonzero(self.lengths == length)
        out = np.zeros(self.width, np.uint64)
        np.bitwise_or.at(out, word >> 6, np.uint64(1) << (word & 63).astype(np.uint64))
        return out

    def near(self, queries: np.ndarray, length: int, least: int, front: bool) -> np.ndarray:
        """Bitsets of the block's words near each query of that length, of the pairs in
        the class of ``least``, which is the smaller length of a pair."""
        shape = (len(queries), self.width)
        zero = np.full(shape, ~np.uint64(0))
        same, more = np.zeros(shape, np.uint64), zero.copy()
        less, halves = np.zeros(shape, np.uint64), None
        here = self.rows(queries[:, 0], 0)
        for i in range(length):
            if i == least // 2:
                halves = zero
            letters = queries[:, i]
            if length == least:
                same = (same & here) | (zero & ~here)
                further = self.rows(letters, i + 1)
                more &= further
            else:
                less = (less & self.rows(letters, i - 1)) | zero
                further = None
            zero = zero & here
            if length == least:
                more |= zero
            if i + 1 < length:
                here = self.rows(queries[:, i + 1], i + 1)
        if halves is None:
            halves = zero
        if length == least:
            out = (same & self.of_length(least)) | (more & self.of_length(least + 1))
        else:
            out = less & self.of_length(least)
        return out & (halves if front else ~halves)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of code points padded with zeros, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    wide = int(lengths.max(initial=0))
    codes = np.array(words, f"<U{max(1, wide)}").view(np.uint32).reshape(len(words), -1)
    return codes, lengths


def _best(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its number of bits and its lowest bit (-1 without any)."""
    count = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
    word = (found != 0).argmax(axis=1)
    bits = found[np.arange(len(found)), word]
    low = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    return count, np.where(count > 0, word * 64 + low, -1)


def search_block(
    members: list[tuple[str, int]], queries: list[str], least: int, front: bool
) -> tuple[np.ndarray, np.ndarray, list[tuple[str, int]]]:
    """For each query the number of its near words among the members, and the place of
    the most frequent one (ties: the first in code-point order) in the list returned."""
    # Code-point order is that of Python's strings.
    ordered = sorted(members, key=lambda m: (-m[1], m[0]))
    index = BitSlices(*code_points([w for w, _ in ordered]))
    counts, best = np.zeros(len(queries), np.int64), np.full(len(queries), -1)
    lengths = np.array([len(q) for q in queries], np.int64)
    for length in (least, least + 1):
        mine = np.flatnonzero(lengths == length)
        step = max(1, min(QUERIES, BLOCK_LETTERS // (length + 1)))
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            codes, _ = code_points([queries[i] for i in some])
            counts[some], best[some] = _best(index.near(codes, length, least, front))
    return counts, best, ordered


_FOUND = "word string, n_near bigint, form string, form_n bigint"
_UNIT = ["least", "front", "bucket", "block", "part"]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searches every unit: rows of one unit follow each other, its members first."""

    def flush(unit, members, queries):
        counts, best, ordered = search_block(members, queries, unit[0], unit[1])
        hit = np.flatnonzero(counts)
        near = [ordered[i] for i in best[hit]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([queries[i] for i in hit], pa.string()),
                pa.array(counts[hit], pa.int64()),
                pa.array([w for w, _ in near], pa.string()),
                pa.array([n for _, n in near], pa.int64()),
            ],
            ["word", "n_near", "form", "form_n"],
        )

    unit, members, queries = None, [], []
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _UNIT]
        rest = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("query", "word", "n")]
        for key, query, word, n in zip(zip(*columns, strict=True), *rest, strict=True):
            if key != unit:
                if queries and members:
                    yield flush(unit, members, queries)
                unit, members, queries = key, [], []
            if query:
                queries.append(word)
            else:
                members.append((word, n))
    if queries and members:
        yield flush(unit, members, queries)


def block_words(least: str, most: int) -> str:
    """Words of a block of a class, as SQL."""
    return f"greatest(64L, least({most}L, {BLOCK_LETTERS}L div ({least} + 1)))"


def near_counts(words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """Rows (word, n, n_near, form, form_n) of the written vocabulary (word, n): the
    number of near words, and the most frequent of them with its occurrences.

    Classes and halves are hashed into buckets of about a block's size. A bucket that
    holds more, as a half that very many words share does, is cut in blocks of members
    and parts of queries, each two of them a unit of their own; a unit holds two blocks'
    words at most, about.
    """
    halves = words.select(
        "word",
        "n",
        F.expr(
            """explode(flatten(transform(array(char_length(word), char_length(word) - 1), l ->
            array(struct(l as least, true as front, left(word, cast(l div 2 as int)) as half),
                  struct(l as least, false as front,
                         right(word, cast(l - l div 2 as int)) as half)))))"""
        ).alias("h"),
    ).select("word", "n", "h.*")
    # A word of the class below is its own length: a pair of two longer words, which are
    # queries and members of the class as well, is not found there.
    sizes = words.groupBy(F.char_length("word").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    classes = (
        sizes.select(F.explode(F.expr("array(l, l - 1)")).alias("least"), "n")
        .groupBy("least")
        .agg(F.sum("n").alias("rows"))
        .select(
            "least",
            F.expr(f"cast(ceil(rows / {block_words('least', most)}) as int)").alias("buckets"),
        )
    )
    classes = stage(classes, "spelling-classes")
    dealt = join_small(halves, classes, ["least"], "inner").withColumn(
        "bucket", F.expr("cast(pmod(xxhash64(half), buckets) as int)")
    )
    dealt = dealt.drop("half", "buckets")
    unit = ["least", "front", "bucket"]
    large = (
        dealt.groupBy(*unit)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.expr(f"rows > 2 * {block_words('least', most)}"))
        .select(
            *unit,
            F.expr(f"cast(ceil(rows / {block_words('least', most)}) as int)").alias("blocks"),
        )
    )
    large = stage(large, "spelling-buckets")
    dealt = (
        join_small(dealt, large, unit, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.expr("cast(pmod(xxhash64(word, 11), blocks) as int)"))
    )
    # A member goes to its block for every part, a query to its part for every block.
    roles = dealt.select(
        *unit,
        "word",
        "n",
        F.expr(
            """explode(flatten(transform(sequence(0, blocks - 1), i -> array(
            struct(false as query, own as block, i as part),
            struct(true as query, i as block, own as part)))))"""
        ).alias("r"),
    ).select(*unit, "r.block", "r.part", "r.query", "word", "n")
    near = (
        roles.repartition(*_UNIT)
        .sortWithinPartitions(*_UNIT, "query")
        .mapInArrow(_search, _FOUND)
    )
    none = words.select(
        "word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("form"),
        F.lit(None).cast("bigint").alias("form_n"),
    )
    every = none.unionByName(near.withColumn("n", F.lit(None).cast("bigint")))
    # The smallest of (not found, fewer, later): the most frequent near word.
    first = F.min(
        F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("w")))
    )
    return (
        every.groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("f"))
        .select("word", "n", "n_near", F.col("f.w").alias("form"), (-F.col("f.n")).alias("form_n"))
    )


def roots_of(forms: DataFrame, label: str = "spelling-roots") -> DataFrame:
    """Rows (word, root) of rows (word, form): the last of the forms that follow each
    other. The occurrences grow by a factor with each form, so paths are short and have
    no cycles; each round doubles the steps taken, on written tables."""
    steps = stage(forms.select("word", F.col("form").alias("root")), label)
    while True:
        ends = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(ends, "root", "left_semi").isEmpty():
            return steps
        further = steps.join(ends, "root", "left")
        steps = stage(
            further.select("word", F.coalesce("next", "root").alias("root")), label
        )


def spelling_variants(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    block: int = BLOCK_WORDS,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    A form is the word's near word of most occurrences (ties: the first in code-point
    order) if it has ``ratio`` times the word's; else form and form_n are null. The root
    is the end of the forms from the word, or the word. Null and empty texts have no
    words; a null doc_id counts as an empty name in the hash; repeated rows count each;
    other columns are not read. An empty table gives no rows. ``least_letters`` is 2 at
    least.
    """
    if least_letters < 2:
        raise ValueError("words of one letter have no halves")
    words = stage(vocabulary(docs, doc, text, least_letters, least_count), "vocabulary")
    found = near_counts(words, block)
    frequent = F.col("form_n") >= ratio * F.col("n")
    found = found.select(
        "word",
        F.when(frequent, F.col("form")).alias("form"),
        "n",
        "n_near",
        F.when(frequent, F.col("form_n")).alias("form_n"),
    )
    found = stage(found, "near-words")
    roots = roots_of(found.filter("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
