"""The corpus pipeline: five operators, one after the other, over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bankmart.llm.common import stored
from bankmart.llm.mixing import mix_sources, mixed_documents, quality_weights
from bankmart.llm.ngram_join import one_of_each_group
from bankmart.llm.queries import table, tokenizer_path
from bankmart.llm.secret_scan import redact_secrets
from bankmart.llm.sentencepiece_codec import encode_documents
from bankmart.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on their labels, finds toxic go."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest doc_id."""
    return one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced in the text."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix of the sources takes it."""
    return mixed_documents(docs, mix_sources(docs, quality_weights(table(spark, sf_dir, "labels"))))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text."""
    return encode_documents(docs, tokenizer_path("piece_bpe_32k.model")).select(
        "doc_id", "ids", "n_pieces", "ids_crc32")


STAGES = [("toxicity", toxicity), ("ngram_join", ngram_join), ("secrets", secrets),
          ("mixing", mixing), ("encoding", encoding)]

# A trained classifier, connected components and a tokenizer have no SQL form:
# tests/llm compares every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
