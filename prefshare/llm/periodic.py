"""Periodic runs of words, by a grammar over the word ids.

A run is a stretch of consecutive words with smallest period q and at least
max(24, 3 q) words that no neighbouring word extends.

1. *Where runs can be.* Any eight consecutive words of a run stand a second time in the
   same text, one period further on or before. Stretches of words that lie in such repeats
   hold all runs whole; the rest of a text is left alone. Repeats are told by ranks of the
   2, 4 and 8 words from each place, which are exact.
2. *Grammar.* Re-Pair replaces the most frequent pair of neighbouring symbols by a new
   nonterminal until no pair is left that occurs twice. Stretches are compressed together,
   with a symbol of its own between each two of them. What is left at the top of a
   stretch is joined two by two, in rounds.
3. *Runs of a nonterminal.* A run lies whole in the smallest nonterminal that spans it, and
   crosses the border between its two halves. So each nonterminal is searched once, for
   the runs in its expansion that cross its border: each place of the border's word is a
   period, whose run reaches as far as the words on both sides agree. Agreement is
   measured by the ranks of 2**k words, for all borders at the same time.
4. *Translation.* Runs move to every place at which the grammar derives the nonterminal.
   One that its nonterminal cuts off lies within a run of the same period, found further
   up; only intervals within no other one of their period are kept.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from prefshare.functions.flags import quoted
from prefshare.llm.common import ragged, rechunked, text_column

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Any so many consecutive words of a run are repeated: a third of the least run.
REPEAT = LEAST_WORDS // LEAST_PERIODS
# Words compressed together, but that a text is never cut; bytes taken from Arrow at once.
CHUNK_WORDS = 100_000
CHUNK_BYTES = 4 << 20
# The longest agreement looked up in one step is 2**MOST_RANKS words.
MOST_RANKS = 12
# Border places looked at together.
PLACES = 1 << 20

Run = tuple[int, int, int]


def ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs, equal for equal pairs."""
    width = int(second.max(initial=0)) + 1
    return np.unique(first * width + second, return_inverse=True)[1]


def rank_tables(ids: np.ndarray, most: int = MOST_RANKS) -> list[np.ndarray]:
    """Table k: ranks of the 2**k ids from each place that has so many."""
    tables = [np.unique(ids, return_inverse=True)[1]]
    while len(tables) <= most and 1 << len(tables) <= len(ids):
        half, last = 1 << (len(tables) - 1), tables[-1]
        tables.append(ranked(last[:-half], last[half:]))
    return tables


def agreement(
    tables: list[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False
) -> np.ndarray:
    """How many ids from the places a and b on are equal, or before them with ``back``,
    at most ``most`` (which keeps within the ids)."""
    out = np.zeros(len(a), np.int64)
    rest = np.flatnonzero(most > 0)
    # The longest steps as often as they hold, then each shorter one once.
    for k in range(len(tables) - 1, -1, -1):
        step, live = 1 << k, rest
        while len(live):
            live = live[out[live] + step <= most[live]]
            shift = -(out[live] + step) if back else out[live]
            same = tables[k][a[live] + shift] == tables[k][b[live] + shift]
            live = live[same]
            out[live] += step
            if k < len(tables) - 1:
                break
    return out


def stretches(ids: np.ndarray, least: int = LEAST_WORDS, repeat: int = REPEAT) -> list[tuple[int, int]]:
    """The parts (start, end) of the ids that can hold runs."""
    if len(ids) < least:
        return []
    # A run holds each of its words three times.
    often = np.bincount(ids)[ids] >= LEAST_PERIODS
    found = []
    for start, end in _spells(often, least):
        found.append(np.arange(start, end))
    if not found:
        return []
    places = np.concatenate(found)
    some = ids[places].astype(np.int64)
    # Words before and after a gap are no neighbours; their eight words are not looked at.
    gram, size = np.unique(some, return_inverse=True)[1].astype(np.int64), 1
    while 2 * size <= repeat:
        gram, size = ranked(gram[:-size], gram[size:]), 2 * size
    if size < repeat:
        gram = ranked(gram[: len(gram) - (repeat - size)], gram[repeat - size :])
    whole = places[repeat - 1 :] - places[: len(places) - repeat + 1] == repeat - 1
    counts = np.bincount(gram[whole], minlength=int(gram.max(initial=0)) + 1)
    begins = np.zeros(len(ids), bool)
    begins[places[: len(gram)][whole & (counts[gram] > 1)]] = True
    return [(a, b + repeat - 1) for a, b in _spells(begins, least - repeat + 1)]


def _spells(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Ranges (start, end) of at least so many set flags in a row."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]


class Grammar:
    """Re-Pair over ids. Rule r has its places in the ids (the first is ``places[r][0]``),
    the length of its left half and its whole length; ``top`` are the places at which the
    symbols that are left begin."""

    def __init__(self, ids: list[int]):
        n = len(ids)
        self.places: list[list[int]] = []
        self.left: list[int] = []
        self.length: list[int] = []
        symbol, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        base = max(ids, default=0) + 1
        pairs: dict[tuple[int, int], list[int]] = {}
        for i in range(n - 1):
            pairs.setdefault((symbol[i], symbol[i + 1]), []).append(i)
        # Most frequent first, and of these the one met first.
        order = 0
        queue = []
        for pair, found in pairs.items():
            order += 1
            if len(found) > 1:
                queue.append((-len(found), order, pair))
        heapify(queue)
        while queue:
            count, age, pair = heappop(queue)
            a, b = pair
            live, end = [], -1
            for i in pairs[pair]:
                j = after[i]
                if i >= end and symbol[i] == a and j < n and symbol[j] == b:
                    live.append(i)
                    end = after[j]
            if len(live) < 2:
                # A pair comes back to the queue when it gets new places.
                pairs[pair] = live
                continue
            if len(live) < -count:
                pairs[pair] = live
                heappush(queue, (-len(live), age, pair))
                continue
            del pairs[pair]
            new = base + len(self.places)
            touched: dict[tuple[int, int], list[int]] = {}
            for i in live:
                j = after[i]
                k = after[j]
                symbol[i], symbol[j] = new, -1
                after[i] = k
                if k < n:
                    before[k] = i
                    touched.setdefault((new, symbol[k]), []).append(i)
                p = before[i]
                if p >= 0:
                    touched.setdefault((symbol[p], new), []).append(p)
            i = live[0]
            self.left.append(self._size(a, base))
            self.length.append(self._size(a, base) + self._size(b, base))
            self.places.append(live)
            for near, found in touched.items():
                pairs[near] = found
                if len(found) > 1:
                    order += 1
                    heappush(queue, (-len(found), order, near))
        self.top = []
        i = 0
        while i < n:
            self.top.append(i)
            i = after[i]

    def _size(self, symbol: int, base: int) -> int:
        return 1 if symbol < base else self.length[symbol - base]


def _joined(top: list[int], bounds: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(place, left length, length) of the joints over the top symbols of each stretch,
    two by two until one is left."""
    at = 0
    for lo, hi in bounds:
        while at < len(top) and top[at] < lo:
            at += 1
        begins = []
        while at < len(top) and top[at] < hi:
            begins.append(top[at])
            at += 1
        while len(begins) > 1:
            ends = [*begins[2::2], hi] if len(begins) % 2 == 0 else begins[2::2]
            for i, end in zip(range(0, len(begins) - 1, 2), ends, strict=True):
                yield begins[i], begins[i + 1] - begins[i], end - begins[i]
            begins = begins[::2]


def crossing_runs(
    ids: np.ndarray, place: np.ndarray, left: np.ndarray, length: np.ndarray,
    least: int = LEAST_WORDS, periods: int = LEAST_PERIODS,
) -> tuple[np.ndarray, ...]:
    """Of nonterminals that begin at the places, the runs in their expansions that cross
    their border, as (nonterminal, start, end, period); starts and ends are in the ids."""
    tables = rank_tables(ids)
    words = tables[0].astype(np.int64)
    # The places of each word, in order: key word * n + place.
    n = len(ids)
    keys = np.sort(words * n + np.arange(n))
    out = []
    for forth in (True, False):
        border = place + left
        end = place + length
        most = length // periods
        if forth:
            # The period lies after the border: the word before it comes again.
            word = words[border - 1]
            lo = np.searchsorted(keys, word * n + border)
            hi = np.searchsorted(keys, word * n + np.minimum(end, border + most), "left")
        else:
            word = words[border]
            lo = np.searchsorted(keys, word * n + np.maximum(place, border - most))
            hi = np.searchsorted(keys, word * n + border, "left")
        counts = np.maximum(hi - lo, 0)
        upto = np.cumsum(counts)
        at = 0
        while at < len(counts):
            base = upto[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, base + PLACES, "right")))
            rule = np.repeat(np.arange(at, stop), counts[at:stop])
            other = keys[ragged(lo[at:stop], counts[at:stop])] % n
            edge = border[rule]
            if forth:
                period = other - (edge - 1)
                front, behind = edge, edge + period
            else:
                period = edge - other
                front, behind = other, edge
            reach = agreement(tables, front, behind, end[rule] - behind)
            back = agreement(tables, front, behind, front - place[rule], back=True)
            size = back + period + reach
            good = (size >= least) & (size >= periods * period)
            good &= (front - back < edge) & (behind + reach > edge)
            out.append(
                np.stack([rule, front - back, behind + reach, period])[:, good]
            )
            at = stop
    rule, start, stop, period = np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)
    # The smallest period of an interval: the others are its multiples.
    order = np.lexsort((period, stop, start, rule))
    rule, start, stop, period = (x[order] for x in (rule, start, stop, period))
    first = np.ones(len(rule), bool)
    first[1:] = (np.diff(rule) != 0) | (np.diff(start) != 0) | (np.diff(stop) != 0)
    return rule[first], start[first], stop[first], period[first]


def runs_of(ids: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of the ids, in order of start and period. Ids of
    different texts may stand behind each other if no two texts share one."""
    bounds = stretches(ids)
    if not bounds:
        return []
    # The stretches one after the other, each followed by an id of its own.
    separate = int(ids.max()) + 1
    parts, starts, inside, at = [], [], [], 0
    for i, (lo, hi) in enumerate(bounds):
        parts += [ids[lo:hi].astype(np.int64), np.array([separate + i])]
        starts.append(lo - at)
        inside.append((at, at + hi - lo))
        at += hi - lo + 1
    text = np.concatenate(parts)
    grammar = Grammar(text.tolist())
    joints = list(_joined(grammar.top, inside))
    place = np.array([p[0] for p in grammar.places] + [j[0] for j in joints], np.int64)
    left = np.array(grammar.left + [j[1] for j in joints], np.int64)
    length = np.array(grammar.length + [j[2] for j in joints], np.int64)
    if not len(place):
        return []
    rule, start, end, period = crossing_runs(text, place, left, length)
    # Every place of the nonterminal.
    counts = np.array([len(p) for p in grammar.places] + [1] * len(joints), np.int64)
    flat = np.fromiter(
        (p for some in grammar.places for p in some), np.int64, int(counts[: len(grammar.places)].sum())
    )
    flat = np.concatenate([flat, np.array([j[0] for j in joints], np.int64)])
    firsts = np.cumsum(counts) - counts
    moved = flat[ragged(firsts[rule], counts[rule])]
    shift = moved - np.repeat(place[rule], counts[rule])
    start, end = (np.repeat(x, counts[rule]) + shift for x in (start, end))
    period = np.repeat(period, counts[rule])
    # Keep what lies in no other interval of its period.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    new = np.cumsum(np.diff(period, prepend=0) != 0)
    reach = np.maximum.accumulate(end + new * (len(text) + 1)) - new * (len(text) + 1)
    kept = np.ones(len(start), bool)
    kept[1:] = (end[1:] > reach[:-1]) | (new[1:] != new[:-1])
    start, end, period = start[kept], end[kept], period[kept]
    # Back to the places in the ids.
    origin = np.array([a for a, _ in inside])
    shift = np.array(starts)[np.searchsorted(origin, start, "right") - 1]
    found = zip((start + shift).tolist(), (end - start).tolist(), period.tolist(), strict=True)
    return sorted(found, key=lambda r: (r[0], r[2]))


def text_words(doc: int | None, text: str) -> list[bytes]:
    """The words between ASCII white space; a tenth of the documents, by their number,
    repeat part of their words to the end."""
    words = text.encode().split()
    h = 1 if doc is None else zlib.crc32(str(doc).encode())
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        unit = words[a : a + p]
        words[a:] = (unit * (-(-(n - a) // p)))[: n - a]
    return words


def _row(words: list[bytes], runs: list[Run]) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    if runs:
        dropped = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            dropped[s + q] += 1
            dropped[s + n] -= 1
        keep = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
        words = [words[i] for i in keep.tolist()]
    return (
        len(runs),
        best and best[0],
        best and best[1],
        best and best[2],
        best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(words)).hexdigest(),
        [{"start": s, "length": n, "period": q} for s, n, q in runs],
    )


def periodic_rows(docs: list[tuple[int | None, str]]) -> list[tuple]:
    """A row for each document, whose words are compressed together."""
    split, parts, base = [], [], 0
    for doc, text in docs:
        words = text_words(doc, text)
        known: dict[bytes, int] = {}
        parts.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64) + base)
        base += len(known)
        split.append(words)
    # No two documents share an id, so no run goes over from one to the next.
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = np.cumsum([0, *map(len, parts)])
    own: list[list[Run]] = [[] for _ in docs]
    for start, length, period in runs_of(ids):
        at = int(np.searchsorted(starts, start, "right")) - 1
        own[at].append((start - int(starts[at]), length, period))
    return [_row(words, runs) for words, runs in zip(split, own, strict=True)]


RUNS = "array<struct<start bigint, length bigint, period bigint>>"
ROW = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    f"exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, runs {RUNS}"
)
_TYPES = [
    *[pa.int64()] * 5,
    pa.string(),
    pa.string(),
    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
]
_NAMES = [c.split()[0] for c in ROW.split(", ")[:8]]


def _found(chunk_words: int) -> Callable:
    def rows(ids: list, texts: list[str]) -> pa.RecordBatch:
        out = periodic_rows(list(zip(ids, texts, strict=True)))
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *columns], [*_NAMES, "runs"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size = 0
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            for doc, text in zip(
                batch.column(0).to_pylist(), text_column(batch, "_text").to_pylist(), strict=True
            ):
                ids.append(doc)
                texts.append(text)
                # A word takes some six bytes.
                size += len(text) // 6 + 1
                if size >= chunk_words:
                    yield rows(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield rows(ids, texts)

    return run


def periodic_runs(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """Per document: doc_id, n_runs; start, length, period and exponent_milli of the run of
    the greatest exact length over period (ties: smallest start, then period; nulls without
    any run); runs_sha256 and collapsed_sha256, of the list of the runs and of the words
    without the repeats; and ``runs``, all of them.

    Each text is taken whole, in the task that reads it, without a shuffle. Null and
    empty texts have no words and no runs, and the checksums of nothing. Words of rows
    without doc_id stay as they are; repeated rows are rows of their own; other columns are
    not read. An empty table gives no rows.
    """
    rows = docs.select(quoted(doc).cast("bigint").alias("doc_id"), quoted(text).alias("_text"))
    return rows.mapInArrow(_found(chunk_words), ROW)
