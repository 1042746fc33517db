"""Counts per repository, and which repositories drop out as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.fetch import DATASET, error_scope


def lost_urls(outcomes: DataFrame) -> DataFrame:
    """``(repo, url, outcome)`` of the unrecoverable URLs."""
    return outcomes.where(error_scope(DATASET, F.col("outcome")) == "repo").select("repo", "url", "outcome")


def aborted_repos(outcomes: DataFrame) -> DataFrame:
    """Repositories with at least one unrecoverable URL; one such URL drops the repository."""
    return lost_urls(outcomes).select("repo").distinct()


def crawl_counts(pages: DataFrame) -> DataFrame:
    """Entries and URLs per repository."""
    return pages.groupBy("repo").agg(
        F.coalesce(F.sum(F.size("entries").cast("bigint")), F.lit(0)).alias("n_entries"),
        F.count(F.lit(1)).alias("n_urls"),
    )


def harvest_reports(parsed: DataFrame, aborted: DataFrame, counts: DataFrame) -> DataFrame:
    """One report per repository.

    ``failed_entries`` is the number of URLs less the number of entries: a page with two entries
    makes up for a failed one, and the result may be negative. A repository that was dropped, could
    not be listed or has no extractor is skipped with zero counts.
    """
    flagged = aborted.select(F.col("repo").alias("name"), F.lit(True).alias("aborted"))
    counted = counts.withColumnRenamed("repo", "name")
    members = F.col("n_members") if "n_members" in parsed.columns else F.size("items")
    df = parsed.withColumn("n_items", F.when(F.col("mode") == "inline", members)).select(
        "repo_pos", "name", "mode", "n_items"
    )
    df = df.join(flagged, "name", "left").join(counted, "name", "left")
    skipped = (F.col("mode") == "none") | F.coalesce(F.col("aborted"), F.lit(False))
    valid = F.coalesce(F.col("n_items").cast("bigint"), F.col("n_entries"), F.lit(0))
    failed = F.coalesce(F.col("n_urls") - F.col("n_entries"), F.lit(0))
    return df.select(
        "repo_pos",
        F.col("name").alias("repo_name"),
        F.when(skipped, 0).otherwise(valid).cast("bigint").alias("valid_entries"),
        F.when(skipped, 0).otherwise(failed).cast("bigint").alias("failed_entries"),
        skipped.alias("skipped"),
    )


def run_report(*reports: DataFrame) -> DataFrame:
    """All reports of a run, in catalog order (``repo_pos``, then ``report_pos``)."""
    columns = ("repo_pos", "report_pos", "repo_name", "valid_entries", "failed_entries", "skipped")
    whole = None
    for report in reports:
        if "report_pos" not in report.columns:
            report = report.withColumn("report_pos", F.lit(0))
        report = report.select(*columns)
        whole = report if whole is None else whole.unionByName(report)
    return whole.orderBy("repo_pos", "report_pos")


def report_json(report: DataFrame) -> DataFrame:
    """Report rows as JSON text with sorted keys."""
    fields = F.struct("failed_entries", "repo_name", "skipped", "valid_entries")
    return report.select("repo_pos", "report_pos", F.to_json(fields).alias("report"))


#: From each repository's outcomes up to the whole run.
LEVELS = (("route", "outcome", "repo"), ("route", "outcome"), ("route",), ("outcome",), ())


def report_levels(pages: DataFrame, levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """``pages (route, outcome, repo, url)`` counted at several levels in one pass.

    Adds to the columns of the levels ``n_urls``, ``n_distinct`` and ``level``: one bit per column, set where the row
    adds up over it (which tells such a null from one that is in the data). Rows are aggregated before the shuffle.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    grouped = pages.groupingSets([[F.col(c) for c in level] for level in levels], *(F.col(c) for c in columns))
    return grouped.agg(
        F.count(F.lit(1)).alias("n_urls"), F.count_distinct("url").alias("n_distinct"), F.grouping_id().alias("level")
    )
