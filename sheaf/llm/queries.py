"""The operators over the driver's whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import (
    cap_filters,
    decontaminate,
    divergence,
    language_id,
    licences,
    line_dedup,
    mixing,
    prefix_trie,
    quality,
    recurrent_lm,
    secret_scan,
    simhash,
    toxicity,
)
from sheaf.llm import oracles
from sheaf.llm.text import doc_hash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Where there is no SQL, results are learned, drawn or aligned: see the brute-force versions in tests/llm.
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    name = function.__name__
    QUERIES[name] = function
    if name in oracles.SQL:
        ORACLES[name] = oracles.SQL[name]
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text without the passages that an earlier one holds."""
    return line_dedup.deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), removed="n_removed")


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of each document by the unigram base and by the recurrent model."""
    held_out = doc_hash(F.col("doc_id"), 5) == 1
    found = recurrent_lm.lm_scores(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of documents with benchmark items."""
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of each document."""
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document by labelled toxicity."""
    found = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document by labelled quality."""
    found = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each vector."""
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    return language_id.languages(table(spark, sf_dir, "documents"))


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document."""
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other sources of a language, and the terms of its own, by divergence, for each source."""
    return divergence.source_divergences(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
