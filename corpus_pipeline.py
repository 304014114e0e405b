"""A training corpus from raw documents: stages over the operators of the subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.llm import catalog, langid, mixing, ngram_join, packing, pii
from prefshare.llm.tokens import default_tokenizer
from prefshare.sources.scratch import stage


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the model. Texts without a letter go, and those in
    letters that no piece learned from the labelled documents has."""
    catalog.importable(spark)
    model = langid.fit_model(docs, langid.default_vocabulary())
    return langid.keep_identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest doc_id.
    Different texts of one doc_id are documents of their own."""
    catalog.importable(spark)
    return ngram_join.one_of_each_group(docs, repeated_ids=True)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, n_chars counted anew."""
    catalog.importable(spark)
    clean = pii.redact(docs, pii.fit_field(docs))
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in mix order; the files that are written hold that order."""
    catalog.importable(spark)
    mixed = mixing.mix(docs, catalog.MIX_WEIGHTS, catalog.MIX_REST)
    return mixing.in_mix_order(mixed).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, numbered in the order of the mix."""
    catalog.importable(spark)
    return packing.pack_documents(docs, default_tokenizer(), end_id=0, file_order=True)


STAGES = [
    ("identify_languages", identify_languages),
    ("drop_near_copies", drop_near_copies),
    ("redact_personal_data", redact_personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next one reads it."""
    docs = catalog.table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
