"""Delimited and Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.sources import schemas
from prefshare.sources.bucketed import is_bucketed, read_bucketed
from prefshare.sources.schemas import Field


def _with_header(spark: SparkSession, path: str | Sequence[str], sep: str) -> DataFrame:
    """Text columns. A file whose header differs from the first one's ends the
    read; without the check its columns would be taken by position."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    paths = path if isinstance(path, str) else list(path)
    return reader.option("sep", sep).csv(paths)


def _typed(field: Field) -> Column:
    text = quoted(field.header)
    value = text.try_cast(field.type)
    if field.strict:
        wrong = F.concat(F.lit(f"{field.header} is no number: "), text)
        value = F.when(
            text.isNotNull() & value.isNull(), F.raise_error(wrong).cast(field.type)
        ).otherwise(value)
    return value.alias(field.name)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: Sequence[Field],
    sep: str = ",",
) -> DataFrame:
    """Header-named columns of delimited files or folders, typed by the layout.

    Columns are found by header, so files may carry more columns or another
    order than the layout; all files read together have the same header. There
    is no inference pass. Text that is no number becomes null in an attribute,
    which no bin rule matches; a quantity that is no number ends the job.
    """
    return _with_header(spark, path, sep).select([_typed(f) for f in layout])


def read_transactions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_delimited(spark, path, schemas.TRANSACTIONS, sep="|")


def read_old_tariff(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.OLD_TARIFF)


def read_new_tariff(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.NEW_TARIFF)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.ATTRIBUTES)


def read_features(
    spark: SparkSession,
    path: str,
    table_format: str = "csv",
    text: Sequence[str] = ("analytic_id", "package"),
) -> DataFrame:
    """Wide derived table written by ``write_table``: id, keys, numbers.

    In a delimited folder the columns come from the header, all as doubles but
    ``id`` and the ``text`` columns.
    """
    if table_format == "parquet":
        return read_parquet(spark, path)
    raw = _with_header(spark, path, "|")
    kinds = {"id": "bigint", **{c: "string" for c in text}}
    return raw.select(
        [quoted(c).try_cast(kinds.get(c, "double")).alias(c) for c in raw.columns]
    )


def read_vectors(spark: SparkSession, path: str, values: Sequence[str]) -> DataFrame:
    """Lines of ``write_vectors`` back to ``key`` and one double per value."""
    line = F.split("value", r"\|", 2)
    numbers = F.split(F.btrim(line[1], F.lit("[]")), ", ")
    return spark.read.text(path).select(
        line[0].cast("bigint").alias("key"),
        *[numbers[i].try_cast("double").alias(v) for i, v in enumerate(values)],
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder; one that was written by key keeps its buckets."""
    if is_bucketed(spark, path):
        return read_bucketed(spark, path)
    return spark.read.parquet(path)
