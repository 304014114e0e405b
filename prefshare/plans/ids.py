"""Customer ids that stay the same from run to run.

The ids given so far are kept in a folder, one generation for each run that met new
customers. A run numbers the customers that no generation has, after the last id, and
writes them as a generation of its own; what was written before is never touched. Ids are
gapless from 0 and follow the key order within a generation. The folder is bucketed by
customer: neither telling new customers nor joining ids shuffles the kept ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.operators.index import dense_index
from prefshare.sources.bucketed import (
    folder_values,
    is_bucketed,
    read_bucketed,
    write_bucketed,
)

GENERATION = "generation"


def kept_ids(spark: SparkSession, store: str) -> DataFrame | None:
    """The ids given so far, as rows (key, id); None before the first run."""
    if not is_bucketed(spark, store):
        return None
    return read_bucketed(spark, store).drop(GENERATION)


def extend_ids(keys: DataFrame, store: str, key: str = "analytic_id") -> DataFrame:
    """Ids of all keys met so far, as rows (key, id).

    ``keys`` may repeat keys and hold nulls, which get no id. Only keys without an id are
    sorted and written; a second run over the same keys writes nothing. A run that was
    stopped before its generation was complete has given no ids. Two runs must not write to
    one folder at the same time.
    """
    spark = keys.sparkSession
    distinct = keys.select(quoted(key)).where(quoted(key).isNotNull()).distinct()
    kept = kept_ids(spark, store)
    given, generation = 0, 0
    if kept is not None:
        distinct = distinct.join(kept, key, "left_anti")
        # Ids are gapless, so their number is the next one.
        given = kept.agg(F.count(F.lit(1))).first()[0]
        generation = 1 + max(map(int, folder_values(spark, store, GENERATION)), default=-1)
    place = "_place" if key.casefold() != "_place" else "__place"
    new = dense_index(distinct, key, place)
    if kept is None or not new.isEmpty():
        new = new.select(
            quoted(key),
            (quoted(place) + given).alias("id"),
            F.lit(generation).alias(GENERATION),
        )
        write_bucketed(new, store, key, mode="overwrite", folders=[GENERATION])
    return kept_ids(spark, store)
