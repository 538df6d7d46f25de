"""The corpus pipeline over ``documents``: toxic documents go, then exact and near duplicates,
the rest is mixed to target weights and packed into token windows.

Each stage is ``f(spark, docs, sf_dir)`` and calls one operator of ``lendscope.llm``; its result is
written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``. SQL can't express the stages (a trained model, XXH64 fingerprints, a
seeded selection, a tokenizer); the tests hold them against brute force.

In every stage an empty table stays empty, a null in any column but ``doc_id``, ``text`` and ``source`` is
passed on, further columns of any name keep their values, and texts are read whole however long they
are. What a stage does with null ids, null or empty texts, ties and repeated rows is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import exact_dedup, language_id, mixing, packing, simhash, toxicity
from lendscope.llm.common import materialize
from lendscope.llm.queries import tokenizer_path
from lendscope.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model of the labels outside the held-out fold. Null and
    empty texts are scored as texts without words; repeated rows and null ids stay or go like any
    others; without labels, or with one label only, all documents stay."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.fit(*toxicity.training_documents(docs, labels, language_id.fold("doc_id", 5) != 0))
    return toxicity.reject(docs, model)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text the row that exact dedup keeps: the longest original
    text, then the smallest id, a null id last. Null and empty texts are one group; of rows repeated in
    id and text one stays."""
    return exact_dedup.keep_first(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest id, then the smallest text
    hash; a null id stays only if all ids of its group are null. Null and empty texts share the
    fingerprint zero."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often and as far as the mix takes them: a row for every whole pass and for every
    range of words. Documents without words go; a null source is a source of its own; rows that agree
    in id, source and number of words are taken alike."""
    return mixing.apply_mix(docs, mixing.mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences. A null or empty text is its end
    id alone; rows with null or repeated ids are documents of their own."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_duplicates), ("simhash_dedup", drop_near_duplicates),
          ("mix_sources", mix), ("pack", pack)]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
