"""One query for each operator of this subpackage, over the whole driver tables."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefshare.llm import (
    binary,
    embedding_dedup,
    fingerprint,
    html_text,
    langid,
    license_scan,
    mixing,
    ngram_join,
    packing,
    periodic,
    pii,
    sharding,
    spelling,
)
from prefshare.llm.oracle import ORACLE
from prefshare.llm.tokens import default_tokenizer
from prefshare.sources.scratch import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Shares in percent; sources that are not named have the rest together.
MIX_WEIGHTS = {"src0": 20} | {f"src{i}": 4 for i in range(1, 20)}
MIX_REST = 4
SHARDS = 8
ARROW_ROWS = 1_000

__all__ = ["ORACLE", "QUERIES"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let the Python workers of this machine import the package, and hand them
    texts in batches that stay small when the texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            p for p in [ROOT, *paths] if p
        )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(run)
    def with_path(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = with_path
    return with_path


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, MIX_WEIGHTS, MIX_REST)


@query
def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    binary.write_tokens(docs, target, default_tokenizer(), end_id=1)
    return binary.read_tokens(spark, target)


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sharding.document_sizes(table(spark, sf_dir, "documents"))
    cut = sharding.assign_shards(sizes, ["doc_id", "text_crc32", "size"], "size", SHARDS)
    return cut.selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        f"'{sharding.LAW}' as law",
        "shard",
        "slot",
        "cast(null as int) as grown_shard",
    )


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.fit_field(docs))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit_model(docs, langid.default_vocabulary()))


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_documents(table(spark, sf_dir, "documents"))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(
        table(spark, sf_dir, "documents"), whole_terms=True
    )


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, default_tokenizer(), end_id=0)


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))
