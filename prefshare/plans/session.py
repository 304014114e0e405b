"""Session settings that follow from the size of the purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

# Bytes one task should read or hold, whatever the size of the input.
TASK_BYTES = 128 * 1024 * 1024
LEAST_PARTITIONS = 8


def settings_for(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a shuffle of that size; only the partition count follows it.

    Partitions start at the target size; the runtime re-plan merges those that
    map-side combining left small and splits those a hot key made large.
    """
    partitions = max(LEAST_PARTITIONS, -(-shuffle_bytes // TASK_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }


def listed_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files and folders, from their listing; names may be patterns."""
    total = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = store.globStatus(path) or []
        if not found:
            raise FileNotFoundError(name)
        total += sum(store.getContentSummary(f.getPath()).getLength() for f in found)
    return total


def build_session(
    name: str, inputs: Sequence[str], shuffle_bytes: int | None = None
) -> SparkSession:
    """A session for a shuffle as large as the listed inputs, or as stated."""
    spark = SparkSession.builder.appName(name).getOrCreate()
    size = listed_bytes(spark, inputs) if shuffle_bytes is None else shuffle_bytes
    for key, value in settings_for(size).items():
        spark.conf.set(key, value)
    return spark
