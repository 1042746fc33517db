"""From raw documents to a training mix: each stage keeps whole documents or lines, and works on what the last one kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from sheaf.llm.text import doc_hash, unused_name
from sheaf.plans.staging import shared_folder

#: Labels of documents whose CRC-32 leaves this remainder stay unseen, as in the query op7_toxicity.
FOLDS, HELD_OUT = 4, 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels, doc_hash(F.col("doc_id"), FOLDS) != HELD_OUT))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those made of nothing else go. ``n_chars`` follows the text."""
    removed = unused_name(docs, "removed")
    found = line_dedup.deduplicate_lines(docs, removed=removed)
    found = found.where((F.col(removed) == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col(removed) > 0, size).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, a row for each copy, with its shard and its position there.

    One copy of a source is cut where the target is reached; ``n_chars`` follows its text.
    """
    cut = unused_name(docs, "cut")
    found = mixing.mix(docs, cut=cut)
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col(cut), size).otherwise(F.col("n_chars")))
    return found.drop(cut)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix),
]

#: Learned scores, fingerprints and drawn permutations have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
