"""Special treatment of single repositories: which one, and the split by publisher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name parts that send a repository to a special route; the first match wins.
ROUTES = (("publisso", "reshape"), ("openagrar", "split"))
# Spellings of the publisher whose records are split off.
PUBLISHER_PATTERN = "(?iu)Thünen[- ]?Institut|Thuenen Institute|Thünen-Atlas"
# Names of the two files of a split, in report order, and of the reshaped file.
SPLIT_TARGETS = ("thunen_atlas", "openagrar")
RESHAPE_TARGET = "publisso"


def route_of(name: Column, routes: tuple[tuple[str, str], ...] = ROUTES) -> Column:
    route = F.lit("generic")
    for part, label in reversed(routes):
        route = F.when(name.contains(part), label).otherwise(route)
    return route


def publish_flag(name: Column, commit: Column) -> Column:
    """Special routes are always published; the others unless ``commit`` is false."""
    return (route_of(name) != "generic") | F.coalesce(commit, F.lit(True))


def publisher_name(entry: Column) -> Column:
    """``publisher.name`` of a canonical entry, ``''`` where there is none."""
    name = F.from_json(entry, "publisher STRUCT<name: STRING>")["publisher"]["name"]
    return F.coalesce(name, F.lit(""))


def split_by_publisher(entries: DataFrame, pattern: str = PUBLISHER_PATTERN) -> DataFrame:
    """Add ``target``: every record goes to exactly one side, in one pass, with its position kept."""
    matched = publisher_name(F.col("entry")).rlike(pattern)
    return entries.withColumn(
        "target", F.when(matched, SPLIT_TARGETS[0]).otherwise(SPLIT_TARGETS[1])
    )


def bad_publishers(entries: DataFrame) -> DataFrame:
    """Records on which a split cannot be decided: not an object, or a publisher of the wrong type.

    They fail the run; see the run errors of a harvest.
    """
    record = F.try_parse_json("entry")
    publisher = F.try_variant_get(record, "$.publisher", "variant")
    name = F.try_variant_get(publisher, "$.name", "variant")
    fine = F.col("entry").startswith("{") & (
        publisher.isNull()
        | (
            F.to_json(publisher).startswith("{")
            & (name.isNull() | F.to_json(name).startswith('"'))
        )
    )
    return entries.where(~fine)


def split_reports(split: DataFrame, repos: DataFrame) -> DataFrame:
    """Two fresh reports per split repository, both always present, with no failures.

    ``repos`` holds ``(repo_pos, repo)`` of the repositories that were split.
    """
    both = repos.withColumn(
        "target",
        F.explode(F.array(*(F.lit(target) for target in SPLIT_TARGETS))),
    )
    counts = split.groupBy("repo", "target").agg(F.count(F.lit(1)).alias("n"))
    return both.join(counts, ["repo", "target"], "left").select(
        "repo",
        "repo_pos",
        (F.col("target") != SPLIT_TARGETS[0]).cast("int").alias("report_pos"),
        F.col("target").alias("repo_name"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("valid_entries"),
        F.lit(0).cast("bigint").alias("failed_entries"),
        F.lit(False).alias("skipped"),
    )
