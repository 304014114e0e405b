"""Packing by minimum bin slack, over the counts of the lengths.

What decides a packing is how many pieces there are of each length, at most
2048 numbers whatever the corpus. On them the driver finds, bin by bin, the
fullest combination of the lengths still there, by subset sums over a bitset,
and takes it as often as its lengths last. Pieces get a rank among those of
their length and from it, in tasks, their sequence and place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefshare.functions.flags import quoted
from prefshare.llm.common import group_ranks, rechunked, text_column
from prefshare.llm.tokens import encoded
from prefshare.operators.index import dense_index
from prefshare.sources.scratch import stage

CAPACITY = 2048
CHUNK_BYTES = 4 << 20
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
# Where the document stands among the files that were read.
PLACE = ("_file", "_row")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of the counted lengths that fills the capacity best.

    Lengths are added from the longest; bit s of ``reach`` says that the sum s
    can be made. Going back, the shorter lengths are used as little as possible.
    """
    lengths = sorted((x for x, n in counts.items() if n and x <= capacity), reverse=True)
    within = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        steps.append((length, reach))
        for _ in range(min(counts[length], capacity // length)):
            wider = reach | (reach << length & within)
            if wider == reach:
                break
            reach = wider
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            used[length] = n
    return used


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences from ``first`` on, each with the given lengths."""

    lengths: dict[int, int]
    times: int
    first: int


def minimum_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up the histogram. Each bin starts with the longest
    length left and takes the fullest combination for the rest of it."""
    left = {x: n for x, n in histogram.items() if n}
    patterns, first = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        lengths = fullest(left, capacity - longest)
        left[longest] += 1
        lengths[longest] = lengths.get(longest, 0) + 1
        times = min(left[x] // n for x, n in lengths.items())
        for x, n in lengths.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        patterns.append(Pattern(lengths, times, first))
        first += times
    return patterns


def _intervals(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length: (first rank, copies in a sequence, first sequence, offset)."""
    taken: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    for p in patterns:
        offset = 0
        for length, n in sorted(p.lengths.items(), reverse=True):
            rank = taken.get(length, 0)
            out.setdefault(length, []).append((rank, n, p.first, offset))
            taken[length] = rank + n * p.times
            offset += n * length
    return {x: np.array(rows, np.int64) for x, rows in out.items()}


def _cut(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            rows = []
            texts = text_column(batch, "_text")
            for row, ids in enumerate(encoded(texts, path, end_id)):
                ids = ids.astype("<u4", copy=False)
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((row, piece, start, len(part), zlib.crc32(part)))
            row, *columns = zip(*rows, strict=True)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            kept = [c for c in batch.schema.names if c != "_text"]
            whole = batch.select(kept).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [whole.column(0), *columns, *whole.columns[1:]],
                ["doc_id", "piece", "start", "length", "ids_crc32", *kept[1:]],
            )

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    doc: str = "doc_id",
    text: str = "text",
    placed: bool = False,
) -> DataFrame:
    """One row for each piece of a document's ids, the end id included; only
    documents longer than the capacity have more than one. With ``placed`` the
    columns that ``in_file_order`` adds are kept."""
    rows = docs.select(
        quoted(doc).cast("bigint").alias("_doc"),
        *(PLACE if placed else ()),
        quoted(text).alias("_text"),
    )
    schema = PIECES + (", _file string, _row bigint" if placed else "")
    return rows.mapInArrow(_cut(tokenizer, end_id, capacity), schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.

    ``pieces`` is read more than once and should be a written table. The counts
    of the lengths go to the driver, the pieces do not. Ranks follow doc_id and
    piece; equal rows may swap places, which gives the same rows.
    """
    histogram = {
        r["length"]: r["n"]
        for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    spans = _intervals(minimum_slack(histogram, capacity))
    order = [F.col(c) for c in ("doc_id", "piece", "ids_crc32")]
    ranked = group_ranks(pieces, ["length"], order, "_rank", sum(histogram.values()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, rank = get["length"].to_numpy(), get["_rank"].to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(rows):
                    continue
                size = int(length[rows[0]])
                table = spans[size]
                row = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1]
                inside = rank[rows] - row[:, 0]
                sequence[rows] = row[:, 2] + inside // row[:, 1]
                offset[rows] = row[:, 3] + inside % row[:, 1] * size
            yield pa.RecordBatch.from_arrays(
                [*(get[n] for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    names = pieces.columns
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return ranked.mapInArrow(place, schema)


def in_file_order(docs: DataFrame) -> DataFrame | None:
    """The rows with the file and the row in it that they were read from; None if
    the frame is not a read of files."""
    try:
        return docs.withColumns(
            {
                PLACE[0]: F.col("_metadata.file_path"),
                PLACE[1]: F.col("_metadata.row_index").cast("bigint"),
            }
        )
    except AnalysisException:
        return None


def numbered_in_order(packed: DataFrame) -> DataFrame:
    """Sequences numbered by where the document of their first piece was read."""
    packed = stage(packed, "sequences")
    first = F.struct(*PLACE, "piece").alias("_first")
    leads = packed.filter("offset = 0").select(F.col("sequence_id").alias("_old"), first)
    numbers = dense_index(leads, "_first", "_new").select("_old", "_new")
    joined = packed.join(numbers, F.col("sequence_id") == F.col("_old"))
    return joined.withColumn("sequence_id", F.col("_new")).select(
        *[c for c in packed.columns if c not in PLACE]
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    file_order: bool = False,
) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as found.

    A null text is empty, that is the end id alone; a null doc_id is kept.
    Repeated rows are packed as often as they stand. Other columns are not
    read. An empty table gives no rows. With ``file_order`` and documents read
    from files, sequences are numbered in the order in which the documents of
    their first pieces stand there.
    """
    rows = in_file_order(docs) if file_order else None
    placed = rows is not None
    pieces = token_pieces(
        rows if placed else docs, tokenizer, end_id, capacity, placed=placed
    )
    packed = pack(stage(pieces, "pieces"), capacity)
    return numbered_in_order(packed) if placed else packed
