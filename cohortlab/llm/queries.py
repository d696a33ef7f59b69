"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm import ann_forest, arrow_shards, embedding_dedup, jaccard_join, language, line_quality, mixing, oracles, packing, periodic_runs, suffix_repeats, superkmer, toxicity, vector_codes
from cohortlab.llm.common import read
from cohortlab.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("op1_token_shards")
def token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = arrow_shards.write_shards(read(spark, sf_dir, "documents"), scratch_dir(spark, "shards"),
                                     public_tokenizers.path("byte_bpe_50k.json"), rule="lead", end_id=2)
    return arrow_shards.read_documents(spark, path)


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_documents(read(spark, sf_dir, "documents"))


@query("op4_super_kmer_dedup", oracles.WORD_WINDOWS)
def super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.dedup(read(spark, sf_dir, "documents")).drop("kept")


@query("op5_weighted_mix", oracles.MIX)
def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("tie")


@query("op6_suffix_repeats")
def suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.dedup(read(spark, sf_dir, "documents")).drop("kept", "removed")


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_jaccard_join", oracles.JACCARD)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents"))


@query("op7_embedding_dedup", oracles.EMBEDDINGS)
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(read(spark, sf_dir, "embeddings"))


@query("op9_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op11_line_quality", line_quality.sql())
def line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(read(spark, sf_dir, "documents"))


@query("op12_vector_codes", vector_codes.sql())
def vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


@query("op13_periodic_runs")
def periodic_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(read(spark, sf_dir, "documents"))
