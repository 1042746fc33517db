"""Queries on counts per repository, dropped repositories, routing and the split."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import functions as F

from queries.corpora import VARIANT_SQL, event_requests, landed_events, publisher_records, table, text
from queries.extraction import extracted_pages
from queries.fetching import REQUESTS_SQL
from queries.registry import query
from sheaf.operators.extract import flatten_entries
from sheaf.operators.fetch import fetch, landed_outcomes, status_outcome
from sheaf.operators.reports import (
    aborted_repos,
    crawl_counts,
    harvest_reports,
    report_json,
    report_levels,
    run_report,
)
from sheaf.operators.routing import publisher_name, route_of, split_by_publisher, split_reports
from sheaf.operators.summaries import DISTINCT_ERROR, RANK_ERROR, estimates, merge_summaries
from sheaf.plans.staging import checkpointed, remove, shared_folder
from sheaf.sinks.snapshots import publish, read_summaries


@query(f"""
SELECT repo, count(*)::BIGINT AS n_urls FROM ({REQUESTS_SQL})
GROUP BY repo HAVING NOT bool_or(outcome = 'technical')
""")
def repo_abort(spark, sf_dir):
    requests = event_requests(spark, sf_dir)
    wanted = requests.select("repo", "url").distinct()
    outcomes = fetch(wanted, checkpointed(landed_outcomes(landed_events(spark, sf_dir))))
    kept = requests.join(aborted_repos(outcomes), "repo", "left_anti")
    return kept.groupBy("repo").agg(F.count(F.lit(1)).alias("n_urls"))


N_ENTRIES_SQL = f"CASE WHEN {VARIANT_SQL} IN (2, 4) THEN 2 WHEN {VARIANT_SQL} IN (6, 8, 9) THEN 1 ELSE 0 END"
REPORTS_SQL = f"""
SELECT source AS repo_name, source = 'src3' AS skipped,
       CASE WHEN source = 'src3' THEN 0 ELSE sum({N_ENTRIES_SQL}) END::BIGINT AS valid_entries,
       CASE WHEN source = 'src3' THEN 0 ELSE count(*) - sum({N_ENTRIES_SQL}) END::BIGINT AS failed_entries
FROM documents GROUP BY source
"""


def source_reports(spark, sf_dir):
    """Reports by source of the documents; ``src3`` is dropped as a whole."""
    sources = table(spark, sf_dir, "documents").select(F.col("source").alias("name")).distinct()
    listings = sources.select(
        F.regexp_extract("name", "[0-9]+", 0).cast("int").alias("repo_pos"),
        "name",
        F.lit("crawl").alias("mode"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    lost = F.when(F.col("name") == "src3", "technical").otherwise("ok")
    outcomes = sources.select(F.col("name").alias("repo"), text("https://example.org/", F.col("name")).alias("url"), lost.alias("outcome"))
    return harvest_reports(listings, aborted_repos(outcomes), crawl_counts(extracted_pages(spark, sf_dir)))


@query(REPORTS_SQL)
def harvest_report(spark, sf_dir):
    return source_reports(spark, sf_dir).drop("repo_pos")


@query(f"""
SELECT repo_pos, report_pos,
       '{{"failed_entries":' || failed_entries || ',"repo_name":"' || repo_name || '","skipped":'
       || skipped || ',"valid_entries":' || valid_entries || '}}' AS report
FROM (SELECT regexp_extract(repo_name, '[0-9]+')::BIGINT AS repo_pos, 0::BIGINT AS report_pos, *
      FROM ({REPORTS_SQL}))
""")
def report_text(spark, sf_dir):
    report = report_json(run_report(source_reports(spark, sf_dir)))
    positions = [F.col(c).cast("bigint").alias(c) for c in ("repo_pos", "report_pos")]
    return report.select(*positions, "report")


@query(f"""
SELECT source AS file_name, sum({N_ENTRIES_SQL})::BIGINT AS row_count
FROM documents GROUP BY source HAVING sum({N_ENTRIES_SQL}) > 0
""")
def nonempty_outputs(spark, sf_dir):
    entries = flatten_entries(extracted_pages(spark, sf_dir))
    return entries.groupBy(F.col("repo").alias("file_name")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query("""
SELECT o_orderkey, name, CASE WHEN name LIKE '%publisso%' THEN 'reshape'
                  WHEN name LIKE '%openagrar%' THEN 'split' ELSE 'generic' END AS route
FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'publisso_' WHEN 1 THEN 'my-openagrar-'
             WHEN 2 THEN 'openagrar_publisso' WHEN 3 THEN 'OpenAgrar' ELSE '' END || o_orderstatus AS name
      FROM orders)
""")
def route_by_name(spark, sf_dir):
    key = F.col("o_orderkey")
    prefix = (
        F.when(key % 5 == 0, "publisso_")
        .when(key % 5 == 1, "my-openagrar-")
        .when(key % 5 == 2, "openagrar_publisso")
        .when(key % 5 == 3, "OpenAgrar")
        .otherwise("")
    )
    names = table(spark, sf_dir, "orders").select(
        "o_orderkey", text(prefix, F.col("o_orderstatus")).alias("name")
    )
    return names.withColumn("route", route_of(F.col("name")))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 7 < 4 THEN 'thunen_atlas' ELSE 'openagrar' END AS target,
       CASE c_custkey % 7 WHEN 0 THEN 'Johann Heinrich von Thünen-Institut'
            WHEN 1 THEN 'THUENEN INSTITUTE' WHEN 2 THEN 'thünen-atlas, Braunschweig'
            WHEN 3 THEN 'THÜNEN INSTITUT' WHEN 4 THEN 'Thunen Institute' ELSE '' END AS publisher
FROM customer
""")
def publisher_split(spark, sf_dir):
    split = split_by_publisher(publisher_records(spark, sf_dir))
    return split.select(
        F.col("url_pos").alias("c_custkey"), "target", publisher_name(F.col("entry")).alias("publisher")
    )


@query("""
SELECT c_mktsegment AS repo, target AS repo_name,
       count(*) FILTER (WHERE (c_custkey % 7 < 4) = (target = 'thunen_atlas'))::BIGINT AS valid_entries,
       0::BIGINT AS failed_entries, false AS skipped
FROM customer, (VALUES ('thunen_atlas'), ('openagrar')) AS t(target) GROUP BY 1, 2
UNION ALL
SELECT DISTINCT 'empty ' || c_mktsegment, target, 0, 0, false
FROM customer, (VALUES ('thunen_atlas'), ('openagrar')) AS t(target)
""")
def split_report(spark, sf_dir):
    split = split_by_publisher(publisher_records(spark, sf_dir))
    segments = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("repo")).distinct()
    repos = segments.unionByName(segments.select(text("empty ", F.col("repo")).alias("repo")))
    return split_reports(split, repos.withColumn("repo_pos", F.lit(0))).drop("repo_pos", "report_pos")


@query("""
SELECT route, outcome, repo, count(*)::BIGINT AS n_urls, count(DISTINCT url)::BIGINT AS n_distinct, GROUPING(route, outcome, repo)::BIGINT AS level
FROM (SELECT CASE user_id % 3 WHEN 0 THEN 'reshape' WHEN 1 THEN 'split' ELSE 'generic' END AS route,
             CASE user_id % 3 WHEN 0 THEN 'publisso_' WHEN 1 THEN 'openagrar_' ELSE 'repo_' END || user_id AS repo,
             CASE WHEN event_type <> 'error' THEN 'ok' WHEN event_id % 5 < 2 THEN 'technical' ELSE 'response' END AS outcome,
             'https://x/' || event_id % 97 AS url FROM events)
GROUP BY GROUPING SETS ((route, outcome, repo), (route, outcome), (route), (outcome), ())
""")
def outcome_levels(spark, sf_dir):
    event, user = F.col("event_id"), F.col("user_id")
    repo = text(F.when(user % 3 == 0, "publisso_").when(user % 3 == 1, "openagrar_").otherwise("repo_"), user)
    status = F.when(F.col("event_type") != "error", 200).when(event % 5 < 2, 503).otherwise(404)
    pages = table(spark, sf_dir, "events").select(
        repo.alias("repo"), status_outcome(status, F.lit(None)).alias("outcome"), text("https://x/", event % 97).alias("url")
    )
    return report_levels(pages.withColumn("route", route_of(F.col("repo"))))


@query("""
WITH rows AS (SELECT 'flag-' || l_returnflag AS file_name, l_orderkey // 8 AS o, l_partkey % 100 AS p,
                     CASE WHEN l_partkey % 3 = 0 THEN 'hot' ELSE 'part-' || l_partkey END AS item FROM lineitem)
SELECT file_name, count(*)::BIGINT AS n_rows, count(DISTINCT (o, p))::BIGINT AS n_distinct, true AS distinct_within,
       true AS quantiles_within, true AS counts_within, 'hot' AS hottest, 2::BIGINT AS n_runs
FROM rows GROUP BY file_name
""")
def published_summaries(spark, sf_dir):
    # Two runs keep summaries; those added up are held against exact figures over the rows of both.
    root = f"{shared_folder(spark)}/summaries-{uuid.uuid4()}"
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("r").alias("repo"),
        text("flag-", F.col("l_returnflag")).alias("file_name"),
        order.alias("url_pos"),
        text('{"order":', F.floor(order / 8), ',"part":', part % 100, "}").alias("entry"),
        F.when(part % 3 == 0, "hot").otherwise(text("part-", part)).alias("item"),
    )
    try:
        for day in (1, 2):
            outputs = rows.where(part % 2 == day - 1)
            files = outputs.groupBy("repo", "file_name").agg(F.count(F.lit(1)).alias("row_count"))
            files = files.withColumns({"url": F.lit("http://r"), "published": F.lit(True)})
            errors = spark.createDataFrame([], "problem string")
            publish(outputs, files, errors, f"{root}/versions", datetime(2024, 1, day, tzinfo=UTC), frequent=F.col("item"), measure=F.col("url_pos"))
        kept = read_summaries(spark, f"{root}/versions")
        runs = kept.groupBy("file_name").agg(F.count_distinct("run").alias("n_runs"))
        found = checkpointed(estimates(merge_summaries(kept, ["file_name"]), ["file_name"], (0.5, 0.99)).join(runs, "file_name"))
    finally:
        remove(spark, root)
    # What is estimated is a row for each file, small enough for a broadcast; the rest aggregates before it shuffles.
    marks = found.select("file_name", *(F.col("quantiles")[i].alias(f"q{i}") for i in range(2)))
    exact = rows.join(marks, "file_name").groupBy("file_name").agg(
        F.count_distinct("entry").alias("distinct"),
        *(F.avg((F.col("url_pos") < F.col(f"q{i}")).cast("int")).alias(f"below{i}") for i in range(2)),
        *(F.avg((F.col("url_pos") <= F.col(f"q{i}")).cast("int")).alias(f"upto{i}") for i in range(2)),
    )
    top = found.select("file_name", "count_error", F.posexplode("frequent").alias("place", "top")).select("file_name", "count_error", "place", "top.*")
    counts = rows.groupBy("file_name", "item").agg(F.count(F.lit(1)).alias("n"))
    counted = top.join(counts, ["file_name", "item"], "left").groupBy("file_name").agg(
        F.every(F.coalesce(F.abs(F.col("count") - F.col("n")) <= F.col("count_error"), F.lit(False))).alias("counts_within"),
        F.min_by("item", "place").alias("hottest"),
    )
    ranks = [(F.col(f"below{i}") <= q + RANK_ERROR) & (F.col(f"upto{i}") >= q - RANK_ERROR) for i, q in enumerate((0.5, 0.99))]
    return found.join(exact, "file_name").join(counted, "file_name").select(
        "file_name",
        "n_rows",
        F.col("distinct").alias("n_distinct"),
        (F.abs(F.col("n_distinct") - F.col("distinct")) <= DISTINCT_ERROR * F.col("distinct")).alias("distinct_within"),
        (ranks[0] & ranks[1]).alias("quantiles_within"),
        "counts_within",
        "hottest",
        "n_runs",
    )
