"""The operators applied to the given tables, as registered queries, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann_search import nearest_neighbours
from .common import id_remainder, small_batches
from .embedding_dedup import embedding_near_dedup
from .language_id import fit_languages, identify_language
from .lexical_search import ranked_search
from .mixing import mix_sources, quality_weights
from .ngram_join import ngram_jaccard_join
from .quality_rules import quality_verdicts
from .secret_scan import scan_secrets
from .sentencepiece_codec import encode_documents
from .sharding import shard_documents
from .sql import ORACLE_SQL  # noqa: F401  (read by the entry adapter)
from .token_files import read_token_files, write_token_files
from .toxicity import fit_toxicity, score_toxicity
from .whitening import whiten_embeddings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    model = fit_toxicity(documents.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return score_toxicity(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = fit_languages(documents.where(~held_out))
    return identify_language(documents, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"),
                       quality_weights(table(spark, sf_dir, "labels"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")) \
        .drop("ids")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return read_token_files(manifest)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_toxicity, op3_language_id, op4_secret_scan, op5_mix_sources,
        op6_sentencepiece, op7_token_files, op8_embedding_dedup, op9_shard_documents, op10_ann_search,
        op11_whitening, op12_quality_rules, op13_ranked_search)
}
