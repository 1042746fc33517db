"""Versioned publishing: append-only snapshots that become visible once the whole run is written."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.summaries import summarize
from sheaf.sinks.documents import POSITION

SNAPSHOTS = (
    "repo_name STRING, file_name STRING, source_url STRING, harvested_at TIMESTAMP, message STRING, "
    "row_count BIGINT"
)


class RunFailed(RuntimeError):
    """A run-wide error: nothing of this run is published."""


def commit_message(producer: str, harvested_at: Column, source_url: Column) -> Column:
    """Provenance text of one published file; the time is in UTC whatever the session's time zone."""
    micros = F.unix_micros(harvested_at)
    in_day = F.pmod(micros, F.lit(_DAY))
    day = F.date_add(F.lit("1970-01-01").cast("date"), ((micros - in_day) / _DAY).cast("int"))
    clock = F.floor(in_day / 1_000_000)
    parts = (F.floor(clock / 3600), F.floor(clock / 60) % 60, clock % 60)
    time = F.concat_ws(":", *(F.lpad(part.cast("string"), 2, "0") for part in parts))
    fraction = F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(
        F.lit(f"harvested by {producer} at "), day.cast("string"), F.lit(" "), time, F.lit("."),
        fraction, F.lit(" UTC+0000 from "), source_url,
    )


_DAY = 86_400_000_000


def _instant(moment: datetime) -> Column:
    """A literal timestamp; a time without zone is UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    since = aware - datetime(1970, 1, 1, tzinfo=UTC)
    return F.timestamp_micros(F.lit(since // timedelta(microseconds=1)).cast("bigint"))


def snapshot_rows(files: DataFrame, harvested_at: Column, producer: str) -> DataFrame:
    """One row per published file ``(repo, file_name, url, row_count)``, also for an empty one."""
    return files.select(
        F.col("repo").alias("repo_name"),
        "file_name",
        F.col("url").alias("source_url"),
        harvested_at.alias("harvested_at"),
        commit_message(producer, harvested_at, F.col("url")).alias("message"),
        F.col("row_count").cast("bigint").alias("row_count"),
    )


def publish(
    outputs: DataFrame,
    files: DataFrame,
    run_errors: DataFrame,
    root: str,
    harvested_at: datetime,
    producer: str = "sheaf",
    frequent: Column | None = None,
    measure: Column | None = None,
) -> None:
    """Append one snapshot of the published files under ``root``.

    Entries are written first, then the manifest, and last the single row that makes the run visible:
    readers start from there, so a run that fails half-way shows nothing, and can be repeated. With ``frequent``, an
    expression over ``outputs``, a summary of each file is kept as well (see ``sheaf.operators.summaries``).
    """
    error = run_errors.limit(1).collect()
    if error:
        raise RunFailed(f"nothing published: {error[0].asDict()}")
    moment = _instant(harvested_at)
    keys = ["repo", "file_name", *(c for c in POSITION if c in outputs.columns)]
    published = files.where("published").select("repo", "file_name")
    data = outputs.join(published, ["repo", "file_name"], "left_semi")
    (
        data.select("*", F.lit(_folder(harvested_at)).alias("run"))
        .repartitionByRange(*(F.col(key) for key in keys))
        .sortWithinPartitions(*keys)
        .write.partitionBy("run", "repo", "file_name")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(f"{root}/data")
    )
    if frequent is not None:
        _write_run(summarize(data, frequent, measure), f"{root}/summaries", harvested_at)
    _write_run(snapshot_rows(files.where("published"), moment, producer), f"{root}/manifest", harvested_at)
    run = outputs.sparkSession.range(1).select(F.lit(_folder(harvested_at)).alias("run"))
    run.write.mode("append").parquet(f"{root}/runs")


def _write_run(rows: DataFrame, path: str, harvested_at: datetime) -> None:
    named = rows.withColumn("run", F.lit(_folder(harvested_at)))
    named.write.partitionBy("run").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def _folder(harvested_at: datetime) -> str:
    utc = harvested_at.astimezone(UTC) if harvested_at.tzinfo else harvested_at
    return utc.strftime("%Y%m%dT%H%M%S%f")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The manifest: every file version of every run that was published as a whole."""
    runs = spark.read.schema("run STRING").parquet(f"{root}/runs")
    manifest = spark.read.schema(f"{SNAPSHOTS}, run STRING").parquet(f"{root}/manifest")
    return manifest.join(runs, "run", "left_semi").drop("run")


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """The summaries ``(repo, file_name, run, ...)`` of every run that was published as a whole and keeps them."""
    runs = spark.read.schema("run STRING").parquet(f"{root}/runs")
    kept = spark.read.parquet(f"{root}/summaries").withColumn("run", F.col("run").cast("string"))
    return kept.join(runs.distinct(), "run", "left_semi")


def read_snapshot(
    spark: SparkSession, root: str, harvested_at: datetime, file_name: str
) -> DataFrame:
    """Entries of one published file version; other runs and files are not scanned."""
    data = spark.read.parquet(f"{root}/data")
    here = (F.col("run") == _folder(harvested_at)) & (F.col("file_name") == file_name)
    shown = (
        read_snapshots(spark, root)
        .where((F.col("harvested_at") == _instant(harvested_at)) & (F.col("file_name") == file_name))
        .select(F.col("repo_name").alias("repo"))
        .distinct()
    )
    return data.where(here).join(shown, "repo", "left_semi").drop("run")
