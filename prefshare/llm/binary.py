"""Token ids as directly addressable codes in segment files.

An id is split into chunks of eight bits, one level for each chunk. A level
holds the chunks of the ids that reach it, a bitmap that says which of them
continue on the next level, and a rank directory with the number of set bits
before each block of 512. The ids of position i are read from one chunk for each
level, without decoding its neighbours.

A data set is a Parquet table with one row for each segment: the ids of
consecutive documents, their doc_ids and where each document ends. Parquet only
carries the segments, so that any store and Spark's commit protocol serve.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import join_small, rechunked, text_column
from prefshare.llm.tokens import encoded

MAGIC = b"DAC1"
BLOCK = 512
SEGMENT_TOKENS = 1 << 20
CHUNK_BYTES = 4 << 20
SCHEMA = (
    "part int, segment int, n_tokens bigint, doc_ids array<bigint>, "
    "ends array<bigint>, codes binary"
)
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class DirectCodes:
    """The levels of one segment."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @staticmethod
    def of(ids: np.ndarray) -> DirectCodes:
        rest, levels = np.asarray(ids, np.uint32), []
        while not levels or len(rest):
            more = rest > 255
            bits = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(
                np.append(more, False).astype(np.uint32), np.arange(0, len(more) + 1, BLOCK)
            )
            ranks = (np.cumsum(ones) - ones).astype(np.uint32)
            levels.append(((rest & 255).astype(np.uint8), bits, ranks))
            rest = rest[more] >> np.uint32(8)
        return DirectCodes(levels)

    def to_bytes(self) -> bytes:
        out = [MAGIC, struct.pack("<I", len(self.levels))]
        for chunks, bits, ranks in self.levels:
            out.append(struct.pack("<Q", len(chunks)))
            out += [chunks.tobytes(), bits.tobytes(), ranks.astype("<u4").tobytes()]
        return b"".join(out)

    @staticmethod
    def from_bytes(raw: bytes) -> DirectCodes:
        if raw[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        (count,), at, levels = struct.unpack_from("<I", raw, 4), 8, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", raw, at)
            at += 8
            parts = []
            for kind, size in (
                (np.uint8, n),
                (np.uint8, -(-n // 8)),
                (np.dtype("<u4"), n // BLOCK + 1),
            ):
                parts.append(np.frombuffer(raw, kind, size, at))
                at += parts[-1].nbytes
            levels.append(tuple(parts))
        return DirectCodes(levels)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            inside = np.unpackbits(
                bits[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little"
            )
            i = int(ranks[block]) + int(inside[: i - block * BLOCK].sum())
            shift += 8
        return value

    def decode(self) -> np.ndarray:
        out = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if len(out):
                more = np.unpackbits(bits, count=len(chunks), bitorder="little")
                value[more.astype(bool)] |= out << np.uint32(8)
            out = value
        return out


def _segments(path: str, end_id: int, segment_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        size = 0

        def cut() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in ids])
            codes = DirectCodes.of(np.concatenate(ids)).to_bytes()
            row = [part, number, int(ends[-1]), docs, ends.tolist(), codes]
            types = [pa.int32(), pa.int32(), pa.int64()]
            types += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "segment", "n_tokens", "doc_ids", "ends", "codes"]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types, strict=True)], names
            )

        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            keys = batch.column(batch.schema.get_field_index("_doc")).to_pylist()
            texts = text_column(batch, "_text")
            for key, x in zip(keys, encoded(texts, path, end_id), strict=True):
                ids.append(x)
                docs.append(key)
                size += len(x)
                if size >= segment_tokens:
                    yield cut()
                    ids, docs, size, number = [], [], 0, number + 1
        if ids:
            yield cut()

    return run


def write_tokens(
    docs: DataFrame,
    target: str,
    tokenizer: str,
    end_id: int = 1,
    doc: str = "doc_id",
    text: str = "text",
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode every whole text, in ascending order of doc_id, into segment rows.

    A null text is empty and holds the end id only; null doc_ids come first.
    Repeated doc_ids are kept, in the order of a hash of their texts. Columns other than
    the two are not read. An empty table gives an empty data set.
    """
    # Range edges are sampled from the order's columns: a hash, not the texts.
    rows = docs.select(
        quoted(doc).alias("_doc"),
        F.xxhash64(quoted(text)).alias("_hash"),
        quoted(text).alias("_text"),
    )
    order = ("_doc", "_hash", "_text")
    rows = rows.repartitionByRange("_doc", "_hash").sortWithinPartitions(*order)
    rows.select("_doc", "_text").mapInArrow(_segments(tokenizer, end_id, segment_tokens), SCHEMA).write.parquet(
        target
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = DirectCodes.from_bytes(row["codes"]).decode().astype("<u4")
            ends = row["ends"]
            starts = [0, *ends[:-1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array([row["_start"] + s for s in starts], pa.int64()),
                    "n_tokens": pa.array(np.subtract(ends, starts), pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(ids[s:e]) for s, e in zip(starts, ends, strict=True)],
                        pa.int64(),
                    ),
                }
            )


def with_starts(segments: DataFrame) -> DataFrame:
    """Segments with ``_start``, the ids in all segments before.

    Totals of the write tasks are summed in one task, one row each; inside a
    write task its segments are summed by a window.
    """
    sizes = segments.select("part", "segment", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select(
        "part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("part").orderBy("segment")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn(
        "_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    ).join(parts, "part")
    starts = placed.select(
        "part", "segment", (F.col("_base") + F.col("_in")).alias("_start")
    )
    return join_small(segments, starts, ["part", "segment"], "inner")


def read_tokens(spark: SparkSession, source: str) -> DataFrame:
    """Per document: its place in the stream, its ids' number and checksum."""
    segments = with_starts(spark.read.schema(SCHEMA).parquet(source))
    return segments.select("_start", "doc_ids", "ends", "codes").mapInArrow(
        _documents, ROWS
    )


def token_at(spark: SparkSession, source: str, position: int) -> int | None:
    """The id at a place of the whole stream; None outside it. Only the segment
    that holds it is read."""
    segments = with_starts(spark.read.schema(SCHEMA).parquet(source))
    one = segments.filter(
        (F.col("_start") <= position)
        & (F.col("_start") + F.col("n_tokens") > position)
    ).first()
    if one is None:
        return None
    return DirectCodes.from_bytes(one["codes"])[position - one["_start"]]
