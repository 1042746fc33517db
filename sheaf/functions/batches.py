"""Batches in which Python gets rows: bounded by their bytes, so that long texts don't add up in a worker."""

from __future__ import annotations

from pyspark.sql import SparkSession

BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch, about; by default 10,000 rows of any length go together.
BATCH_BYTES = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python in batches of ``BATCH_BYTES``, unless it was started with a bound of its own.

    Spark reads the setting where a plan is run, so it stays for what the session runs after.
    """
    if not spark.sparkContext.getConf().contains(BYTES_SETTING):
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))
