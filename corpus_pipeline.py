"""A corpus pipeline of the training-data operators: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared scratch folder and rereads it as the next stage's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlab.llm import jaccard_join, language, mixing, packing, superkmer
from cohortlab.llm.common import keep, read


#: Columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(stage):
    """``stage`` with further columns out of its way: whatever they are called, they come back as they were."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe = [c if c in COLUMNS else f"extra_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*safe), sf_dir).toDF(*docs.columns)
    return run


@shielded
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: those without text or without a letter (``und``) go."""
    found = language.identify(docs, language.sample(docs))
    return found.where(found.lang_pred != language.UND).select(*docs.columns)


@shielded
def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (Jaccard 0.8 on five-word shingles), the least ``doc_id``."""
    return jaccard_join.apply_join(docs)


@shielded
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under 50-word windows that a document with a smaller id has; emptied documents go."""
    return superkmer.apply_dedup(docs)


@shielded
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of at most 2048 tokens with its sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", known_language), ("jaccard_join", one_of_each_class), ("substring_dedup", without_repeats),
          ("mix_sources", mixed_sources), ("pack_sequences", packed_sequences)]

#: Tokenizing is beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
