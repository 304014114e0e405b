"""Contiguous shards of near equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import fresh_name
from prefshare.sources.scratch import stage

LAW = "bytes"


def assign_shards(
    df: DataFrame, order: list[str], size: str, shards: int
) -> DataFrame:
    """The rows with ``shard`` and ``slot``, cut along the given order.

    Rows are range-partitioned and written once; the totals of the partitions
    (one row each) give every partition the bytes and rows before it, and a sum
    inside the partition the rest. A row goes to the shard in whose target the
    middle of its bytes lies, so each cut is off its target by half a row at
    most. Slots count from 0 within a shard.

    Sizes must be positive. Rows equal in the whole order may swap places. A
    table that has columns ``shard`` or ``slot`` gets them replaced; an empty
    table gives no rows.
    """
    columns = [c for c in df.columns if c.casefold() not in ("shard", "slot")]
    part, row, upto, base, first = (
        fresh_name(df, c) for c in ("_part", "_row", "_upto", "_base", "_first")
    )
    keys = [quoted(c) for c in order]
    placed = stage(
        df.select(*map(quoted, columns))
        .repartitionByRange(*keys)
        .withColumn(part, F.spark_partition_id()),
        "shards",
    )
    totals = placed.groupBy(quoted(part)).agg(
        F.sum(quoted(size)).alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.orderBy(quoted(part)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    bases = totals.select(
        quoted(part),
        F.struct(
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("rows"),
            F.sum("_bytes").over(whole).alias("all"),
        ).alias(base),
    )
    inside = Window.partitionBy(quoted(part)).orderBy(*keys)
    summed = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row for each range partition, as many as there are shuffle partitions.
    joined = placed.withColumns(
        {upto: F.sum(quoted(size)).over(summed), row: F.row_number().over(inside) - 1}
    ).join(F.broadcast(bases), part)
    doubled = 2 * (F.col(f"{base}.bytes") + quoted(upto)) - quoted(size)
    # Whole numbers throughout; the middle of a row is always inside the total.
    cut = F.call_function("div", doubled * shards, 2 * F.col(f"{base}.all")).cast("int")
    numbered = joined.select(
        *map(quoted, columns),
        cut.alias("shard"),
        (F.col(f"{base}.rows") + quoted(row)).cast("bigint").alias(row),
    )
    # One row for each shard.
    firsts = numbered.groupBy("shard").agg(F.min(quoted(row)).alias(first))
    return numbered.join(F.broadcast(firsts), "shard").select(
        *map(quoted, columns),
        "shard",
        (quoted(row) - F.col(first)).cast("bigint").alias("slot"),
    )


def document_sizes(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes and one more) and the text's checksum; a null
    text has no bytes."""
    whole = F.coalesce(quoted(text), F.lit(""))
    return docs.select(
        quoted(doc).alias("doc_id"),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole).alias("text_crc32"),
    )


def write_shards(assigned: DataFrame, target: str) -> None:
    """One folder for each shard."""
    assigned.write.partitionBy("shard").parquet(target)
