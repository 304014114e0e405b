"""Scores written range by range of customer ids, so that a run that was stopped goes on.

The persona lies in id order, so a range reads only the files that hold it. Each range is
written to a folder of its own and then entered in a ledger; a run skips the ranges that
are entered and writes the others anew. What no entry names does not count. Small ranges
that follow each other are written by one job, so that the number of jobs follows the
number of ids and not that of the ranges.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.sources.ordered import manifest_of

LEDGER, PLAN = "_ledger", "_plan"
# The name of the ranges' folders.
IDS = "ids"
# Ids that one job writes where the ranges are smaller; what a stopped run loses at most.
JOB_IDS = 1_000_000
Produce = Callable[[int, int], DataFrame]


def ranges_over(rows: int, size: int) -> list[tuple[int, int]]:
    """Ranges (low, high), ends included, of so many ids that cover 0 to rows - 1."""
    if size < 1:
        raise ValueError("a range holds one id at least")
    return [(low, min(low + size, rows) - 1) for low in range(0, rows, size)]


def ranges_of(spark: SparkSession, path: str, size: int) -> list[tuple[int, int]]:
    """Ranges over the ids of a folder in id order."""
    rows = manifest_of(spark, path).agg(F.sum("rows")).first()[0]
    return ranges_over(rows or 0, size)


def written_together(
    ranges: list[tuple[int, int]], ids: int = JOB_IDS
) -> list[list[tuple[int, int]]]:
    """The ranges in groups that one job writes: they follow each other, are equally wide
    but for a narrower last one, and hold up to so many ids. A wider range is alone."""
    groups: list[list[tuple[int, int]]] = []
    width = 0
    for low, high in ranges:
        if groups:
            begin, (before, end) = groups[-1][0][0], groups[-1][-1]
            follows = low == end + 1 and end - before + 1 == width >= high - low + 1
            if follows and high - begin + 1 <= ids:
                groups[-1].append((low, high))
                continue
        groups.append([(low, high)])
        width = high - low + 1
    return groups


class Ledger:
    """The finished ranges of an output folder, as empty files named by their ids."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        # Looked up once: there may be very many ranges.
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.out).getFileSystem(conf)

    def _at(self, name: str):
        return self._path(f"{self.out}/{name}"), self._files

    def open(self, plan: str) -> None:
        """Note what the ranges are made of; another plan in the same folder is refused,
        for its ranges would not fit together."""
        path, files = self._at(PLAN)
        if files.exists(path):
            told = self.spark.read.text(f"{self.out}/{PLAN}").collect()
            if [r[0] for r in told] != [plan]:
                raise ValueError(f"{self.out} was begun with another plan: {told}")
            return
        frame = self.spark.createDataFrame([(plan,)], "value string").coalesce(1)
        frame.write.mode("overwrite").text(f"{self.out}/{PLAN}")

    def enter(self, low: int, high: int) -> None:
        path, files = self._at(f"{LEDGER}/{low}-{high}")
        files.create(path, True).close()

    def finished(self) -> set[tuple[int, int]]:
        path, files = self._at(f"{LEDGER}/*")
        names = [f.getPath().getName() for f in files.globStatus(path) or []]
        return {tuple(map(int, n.split("-"))) for n in names if not n.startswith(".")}

    def name(self, low: int, high: int) -> str:
        return f"{IDS}={low:012d}-{high:012d}"

    def folder(self, low: int, high: int) -> str:
        return f"{self.out}/{self.name(low, high)}"

    def folders(self) -> set[str]:
        """Names of the ranges' folders, whether entered or not."""
        path, files = self._at(f"{IDS}=*")
        return {f.getPath().getName() for f in files.globStatus(path) or []}

    def remove(self, low: int, high: int) -> None:
        path, files = self._at(self.name(low, high))
        files.delete(path, True)

    def complete(self, low: int, high: int) -> None:
        """Mark a folder as Spark marks one that a job wrote by itself."""
        path, files = self._at(f"{self.name(low, high)}/_SUCCESS")
        files.create(path, True).close()


def _write_alone(ledger: Ledger, low: int, high: int, produce: Produce) -> None:
    produce(low, high).write.mode("overwrite").parquet(ledger.folder(low, high))


def _write_group(
    ledger: Ledger, group: list[tuple[int, int]], produce: Produce, name: str
) -> None:
    """The rows of a group's ranges by one job, each range in its own folder."""
    (begin, first_end), end = group[0], group[-1][1]
    rows = produce(begin, end)
    if IDS in {c.casefold() for c in rows.columns}:
        raise ValueError(f"a column is named like the ranges' folders: {IDS}")
    # No entry names these folders: what they hold is of a run that was stopped.
    there = ledger.folders()
    for low, high in group:
        if ledger.name(low, high) in there:
            ledger.remove(low, high)
    width = F.lit(first_end - begin + 1).cast("bigint")
    offset = F.col(name) - F.lit(begin).cast("bigint")
    low = F.col(name) - F.pmod(offset, width)
    high = F.least(low + width - 1, F.lit(end).cast("bigint"))
    dealt = rows.withColumn(IDS, F.format_string("%012d-%012d", low, high))
    (
        # A range is a file, not a file of every task.
        dealt.repartition(IDS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(IDS)
        .parquet(ledger.out)
    )
    there = ledger.folders()
    for low, high in group:
        if ledger.name(low, high) in there:
            ledger.complete(low, high)
        else:
            # Without rows there is no folder yet.
            _write_alone(ledger, low, high, produce)


def write_ranges(
    spark: SparkSession,
    out: str,
    ranges: list[tuple[int, int]],
    produce: Produce,
    label: str = "",
    most: int | None = None,
    name: str | None = None,
) -> list[tuple[int, int]]:
    """Write every range that the folder's ledger does not have, ``most`` of them at a
    time if given, and return those written.

    ``produce(low, high)`` makes the rows of a range; ``label`` names what they are. A
    range whose run ended before its entry is written anew. With ``name``, the column of
    the ids in the rows, small ranges are written together (``written_together``), and
    ``produce`` may be asked for several that follow each other.
    """
    ledger = Ledger(spark, out)
    ledger.open(json.dumps({"label": label, "ranges": ranges}))
    done = ledger.finished()
    open_ranges = [r for r in ranges if tuple(r) not in done][:most]
    groups = [[r] for r in open_ranges] if name is None else written_together(open_ranges)
    for group in groups:
        if len(group) == 1:
            _write_alone(ledger, *group[0], produce)
        else:
            _write_group(ledger, group, produce, name)
        for low, high in group:
            ledger.enter(low, high)
    return open_ranges


def read_ranges(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all finished ranges, which do not overlap."""
    ledger = Ledger(spark, out)
    paths = [ledger.folder(*r) for r in sorted(ledger.finished())]
    if not paths:
        raise FileNotFoundError(f"{out} has no finished range")
    return spark.read.parquet(*paths)
