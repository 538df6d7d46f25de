"""The registered queries of the operators in this subpackage, with their DuckDB SQL where SQL
can express them. Each applies its operator with production parameters to its whole table; what it
returns for nulls, empty and very long texts, ties, repeated rows, empty tables and further columns is
stated in its operator's docstring (very long texts are always read whole)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendscope.llm import (
    exact_dedup, hnsw, language_id, minhash, mixing, packing, resampling, simhash, substring_dedup, tokens, toxicity, url_filter,
    vector_codes,
)
from lendscope.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(key: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE_SQL[key] = sql
        return fn
    return wrap


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_register("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents")).drop("kept_text")


@_register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = language_id.fold("doc_id", 4) == 2
    samples = language_id.training_samples(docs, ~held_out, "doc_id", "text", "lang")
    found = language_id.identify(docs, samples)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_symbol")


@_register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = language_id.fold("doc_id", 5) == 0
    model = toxicity.fit(*toxicity.training_documents(docs, labels, ~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


@_register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())


@_register("op5_simhash_dedup")
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@_register("op6_pack")
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


@_register("op7_nearest_vectors")
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(read_table(spark, sf_dir, "embeddings"))


@_register("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


@_register("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


@_register("op10_exact_dedup", exact_dedup.ORACLE)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


@_register("op11_minhash_dedup")
def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_components(read_table(spark, sf_dir, "documents"))


@_register("op12_vector_codes", vector_codes.ORACLE)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(read_table(spark, sf_dir, "embeddings"))


@_register("op13_importance_resample")
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
