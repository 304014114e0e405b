"""Measured table sizes, the only ground for a broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefshare.functions.flags import quoted

# Payload up to which a table may be sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Row overhead counted on top of the payload.
ROW_BYTES = 16


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(ROW_BYTES + 8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            text = quoted(f.name)
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def measured_bytes(*frames: DataFrame) -> int:
    """Payload bytes of all frames, summed in one job on the executors."""
    sizes = [df.agg(F.sum(_row_bytes(df)).alias("bytes")) for df in frames]
    return sum(r[0] or 0 for r in reduce(DataFrame.unionAll, sizes).collect())


def repeated_bytes(rows: DataFrame, values: DataFrame) -> int:
    """A bound for a join that gives each row one of the values: the rows' payload
    and, for each, the longest text of every text column. Measured in one job,
    without the join."""
    texts = [f.name for f in values.schema.fields if isinstance(f.dataType, T.StringType)]
    longest = sum(
        (F.coalesce(F.max(F.octet_length(quoted(c))), F.lit(0)) for c in texts), F.lit(0)
    )
    longest = (longest + 8 * len(values.columns)).cast("bigint")
    own = rows.agg(F.sum(_row_bytes(rows)).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    each = values.agg(longest.alias("bytes"), F.lit(None).cast("bigint").alias("rows"))
    size, count, value = 0, 0, 0
    for row in own.unionAll(each).collect():
        if row["rows"] is None:
            value = row["bytes"]
        else:
            size, count = row["bytes"] or 0, row["rows"]
    return size + count * value


def fits(*frames: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(*frames) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a table measured as small; leave any other to a shuffle join.

    In the shuffle join the runtime re-plan splits partitions that a hot key
    has made too large.
    """
    return F.broadcast(df) if fits(df, limit=limit) else df
