"""``file:`` URLs, answered from a scan of the files they may point to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.urls import file_path, plain_path


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` as ``(path, body)``; contents are read only where ``body`` is used."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    local = F.regexp_replace("path", "^file:/+", "/")
    return files.select(plain_path(local).alias("path"), F.col("content").alias("body"))


def file_responses(requests: DataFrame, files: DataFrame, base_dir: str = "") -> DataFrame:
    """Answer the ``file:`` URLs in ``requests.url`` as landed responses.

    Relative paths start at ``base_dir``. A URL whose file is missing gets no row; the fetch step
    reads that as a response error.
    """
    path = file_path(F.col("url"))
    absolute = F.when(path.startswith("/") | F.lit(base_dir == ""), path).otherwise(
        plain_path(F.concat(F.lit(base_dir.rstrip("/") + "/"), path))
    )
    wanted = requests.select("url").distinct().withColumn("path", absolute)
    found = wanted.where(F.col("path").isNotNull()).join(files, "path")
    return found.select(
        "url", F.lit(200).alias("status"), "body", F.lit(None).cast("string").alias("net_error")
    )
