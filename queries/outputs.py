"""Queries on outputs and on whole harvests."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries.corpora import (
    CUSTOMERS_PER_LISTING,
    DOCS_PER_LISTING,
    PARTS_PER_LISTING,
    VARIANT_SQL,
    crawl_inputs,
    fanout_records,
    inline_inputs,
    publisher_records,
    split_inputs,
    table,
    text,
)
from queries.registry import query
from queries.reshaping import FANOUT_SQL
from sheaf.operators.changes import version_changes
from sheaf.operators.reshape import reshape
from sheaf.operators.routing import split_by_publisher
from sheaf.plans.harvest import (
    final_report,
    harvest,
    output_files,
    route_outputs,
)
from sheaf.sinks.documents import document_lines
from sheaf.plans.staging import Stage, checkpointed, remove, shared_folder
from sheaf.sinks.snapshots import RunFailed, publish, read_snapshot, read_snapshots, snapshot_rows
from sheaf.sources.responses import read_responses
from sheaf.streaming.incremental import advance, extracted_responses, read_extracted, stream_responses


@query("""
SELECT 'user-' || user_id AS repo_name, 'user-' || user_id || '.json' AS file_name,
       'https://example.org/' || event_id AS source_url, ts AS harvested_at,
       'harvested by sheaf at ' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || ' UTC+0000 from https://example.org/'
       || event_id AS message, event_id AS row_count
FROM events
""")
def snapshot_publish(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    files = events.select(
        text("user-", F.col("user_id")).alias("repo"),
        text("user-", F.col("user_id"), ".json").alias("file_name"),
        text("https://example.org/", F.col("event_id")).alias("url"),
        F.col("event_id").alias("row_count"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    rows = snapshot_rows(files, F.col("ts"), "sheaf")
    return rows.withColumn("harvested_at", F.col("harvested_at").cast("timestamp_ntz"))


@query("""
SELECT file_name, url_pos,
       CASE WHEN url_pos = min(url_pos) OVER (PARTITION BY file_name) THEN '[' || chr(10) ELSE '' END
       || '  {' || chr(10) || '    "name": "' || c_name || '"'
       || CASE c_custkey % 7 WHEN 5 THEN ',' || chr(10) || '    "publisher": {' || chr(10)
               || '      "url": null' || chr(10) || '    }'
               WHEN 6 THEN ''
               ELSE ',' || chr(10) || '    "publisher": {' || chr(10) || '      "name": "'
               || CASE c_custkey % 7 WHEN 0 THEN 'Johann Heinrich von Thünen-Institut'
                  WHEN 1 THEN 'THUENEN INSTITUTE' WHEN 2 THEN 'thünen-atlas, Braunschweig'
                  WHEN 3 THEN 'THÜNEN INSTITUT' ELSE 'Thunen Institute' END
               || '"' || chr(10) || '    }' END
       || ',' || chr(10) || '    "id": ' || c_custkey || chr(10) || '  }'
       || CASE WHEN url_pos = max(url_pos) OVER (PARTITION BY file_name) THEN chr(10) || ']' ELSE ',' END
       AS value
FROM (SELECT *, c_mktsegment || '.json' AS file_name, c_custkey AS url_pos FROM customer)
""")
def document_text(spark, sf_dir):
    records = publisher_records(spark, sf_dir)
    outputs = records.withColumn("file_name", text(F.col("repo"), ".json"))
    return document_lines(outputs, indent=2).select("file_name", "url_pos", "value")


@query("""
WITH split AS (SELECT 'openagrar-' || c_custkey % 2 AS repo,
        CASE WHEN c_custkey % 7 < 4 THEN 'thunen_atlas' ELSE 'openagrar' END || '.json' AS file_name, c_custkey AS url_pos,
        '{"name":"' || c_name || '"' || CASE c_custkey % 7 WHEN 5 THEN ',"publisher":{"url":null}' WHEN 6 THEN ''
          ELSE ',"publisher":{"name":"' || CASE c_custkey % 7 WHEN 0 THEN 'Johann Heinrich von Thünen-Institut'
            WHEN 1 THEN 'THUENEN INSTITUTE' WHEN 2 THEN 'thünen-atlas, Braunschweig' WHEN 3 THEN 'THÜNEN INSTITUT'
            ELSE 'Thunen Institute' END || '"}' END || ',"id":' || c_custkey || '}' AS entry FROM customer)
SELECT repo, file_name, url_pos,
       CASE WHEN url_pos = min(url_pos) OVER file THEN '[' || chr(10) ELSE '' END || entry
       || CASE WHEN url_pos = max(url_pos) OVER file THEN chr(10) || ']' ELSE ',' END AS value
FROM split WINDOW file AS (PARTITION BY repo, file_name)
UNION ALL
SELECT DISTINCT 'openagrar-none', name || '.json', NULL::BIGINT, '[]' FROM customer, (VALUES ('thunen_atlas'), ('openagrar')) AS t(name)
""")
def split_documents(spark, sf_dir):
    # Two repositories share the split's file names; a third has no entries.
    records = publisher_records(spark, sf_dir).withColumn("repo", text("openagrar-", F.col("url_pos") % 2))
    split = split_by_publisher(records).withColumn("file_name", text(F.col("target"), ".json")).drop("target")
    names = split.select("file_name").distinct()
    files = split.select("repo", "file_name").unionByName(names.select(F.lit("openagrar-none").alias("repo"), "file_name"))
    return document_lines(split, files).select("repo", "file_name", "url_pos", "value")


@query(f"""
SELECT 'publisso-' || k % 2 AS repo, count(*)::BIGINT AS n_lines, 1::BIGINT AS n_open, 1::BIGINT AS n_close,
       (count(*) - 1)::BIGINT AS n_commas, count(*)::BIGINT AS n_entries
FROM ({FANOUT_SQL}) WHERE k % 6 <> 3 GROUP BY 1
""")
def reshape_documents(spark, sf_dir):
    records = fanout_records(spark, sf_dir).withColumn("repo", text("publisso-", F.col("url_pos") % 2))
    lines = document_lines(reshape(records, "drop").withColumn("file_name", F.lit("publisso.json")))
    entry = F.btrim("value", F.lit("[],\n"))

    def times(condition):
        return F.sum(condition.cast("bigint"))

    return lines.groupBy("repo").agg(
        F.count(F.lit(1)).alias("n_lines"),
        times(F.col("value").startswith("[\n")).alias("n_open"),
        times(F.col("value").endswith("\n]")).alias("n_close"),
        times(F.col("value").endswith(",")).alias("n_commas"),
        times(F.try_parse_json(entry).isNotNull()).alias("n_entries"),
    )


CRAWL_SQL = f"""
SELECT part AS repo_pos, 0::BIGINT AS report_pos, 'repo-' || part AS repo_name,
       CASE WHEN skipped THEN 0 ELSE valid END::BIGINT AS valid_entries,
       CASE WHEN skipped THEN 0 ELSE n - valid END::BIGINT AS failed_entries, skipped
FROM (SELECT part, count(*) AS n, part % 10 IN (7, 8, 9)
             OR (part % 10 = 6 AND bool_or(within = 3)) AS skipped,
             sum(CASE WHEN within IN (4, 5) THEN 0 WHEN v IN (2, 4) THEN 2
                      WHEN v IN (6, 8, 9) THEN 1 ELSE 0 END) AS valid
      FROM (SELECT doc_id // {DOCS_PER_LISTING} AS part, doc_id % {DOCS_PER_LISTING} AS within,
                   {VARIANT_SQL} AS v FROM documents) GROUP BY part)
"""


def _report(report):
    positions = [F.col(c).cast("bigint").alias(c) for c in ("repo_pos", "report_pos")]
    return report.select(*positions, "repo_name", "valid_entries", "failed_entries", "skipped")


@query(CRAWL_SQL)
def harvest_crawl(spark, sf_dir):
    repos, listed, paged = crawl_inputs(spark, sf_dir)
    with Stage(spark) as stage:  # listings and pages are read more than once
        done = harvest(repos, paged, unique_urls=True, listing_responses=listed, stage=stage)
        return checkpointed(_report(final_report(done.reports, done.entries)))


@query(f"""
WITH rows AS (SELECT k, k // {PARTS_PER_LISTING} AS part FROM ({FANOUT_SQL})),
bad AS (SELECT p_partkey // {PARTS_PER_LISTING} AS part, min(p_partkey) AS first_bad FROM part
        WHERE p_partkey % 6 = 3 AND p_partkey // {PARTS_PER_LISTING} % 2 = 1 GROUP BY 1),
counts AS (SELECT rows.part, count(*) AS n FROM rows LEFT JOIN bad USING (part)
           WHERE (k % 6 <> 3 OR part % 2 = 0) AND (first_bad IS NULL OR k < first_bad) GROUP BY 1),
own AS (SELECT p_partkey // {PARTS_PER_LISTING} AS part, count(*) AS n FROM part GROUP BY 1)
SELECT 'publisso-' || part AS repo, 'publisso-' || part || '.json' AS file_name, false AS published,
       n::BIGINT AS row_count FROM own
UNION ALL
SELECT 'publisso-' || part, 'publisso.json', true, coalesce(counts.n, 0)::BIGINT
FROM own LEFT JOIN counts USING (part)
""")
def harvest_inline(spark, sf_dir):
    done = harvest(*(inputs := inline_inputs(spark, sf_dir)))
    repos = inputs[0]
    outputs = route_outputs(done.entries)
    files = output_files(done.reports, repos, outputs)
    return files.select("repo", "file_name", "published", "row_count")


@query(f"""
WITH pages AS (SELECT c_custkey // {CUSTOMERS_PER_LISTING} AS part,
                      c_custkey % 7 < 4 AND c_custkey % {CUSTOMERS_PER_LISTING} <> 7 AS split_off,
                      c_custkey % 7 >= 4 AND c_custkey % {CUSTOMERS_PER_LISTING} <> 7 AS remains FROM customer)
SELECT part AS repo_pos, 0::BIGINT AS report_pos, 'thunen_atlas' AS repo_name,
       count(*) FILTER (WHERE split_off)::BIGINT AS valid_entries, 0::BIGINT AS failed_entries, false AS skipped
FROM pages WHERE part % 9 <> 8 GROUP BY part
UNION ALL
SELECT part, 1, 'openagrar', count(*) FILTER (WHERE remains), 0, false
FROM pages WHERE part % 9 <> 8 GROUP BY part
UNION ALL
SELECT DISTINCT part, 0, 'openagrar-' || part, 0, 0, true FROM pages WHERE part % 9 = 8
""")
def harvest_split(spark, sf_dir):
    done = harvest(*split_inputs(spark, sf_dir))
    return _report(final_report(done.reports, done.entries))


@query(f"""
WITH docs AS (SELECT *, doc_id // {DOCS_PER_LISTING} AS part, doc_id % {DOCS_PER_LISTING} AS within, {VARIANT_SQL} AS v FROM documents),
parts AS (SELECT part, part % 10 = 6 AND bool_or(within = 3) AS lost FROM docs GROUP BY part)
SELECT 'repo-' || part AS repo, 'listing: repo' AS scope, CASE WHEN part % 10 = 7 THEN 'response' ELSE 'malformed' END AS outcome,
       NULL::BIGINT AS within
FROM parts WHERE part % 10 IN (7, 8)
UNION ALL
SELECT 'repo-' || part, 'repo', 'technical', NULL FROM parts WHERE lost
UNION ALL
SELECT 'repo-' || part, 'dataset', CASE within WHEN 4 THEN 'response' WHEN 5 THEN 'decode' ELSE 'parse' END, within
FROM docs JOIN parts USING (part) WHERE part % 10 < 7 AND NOT lost AND (within IN (4, 5) OR v IN (1, 3, 5))
""")
def drop_causes(spark, sf_dir):
    repos, listed, paged = crawl_inputs(spark, sf_dir)
    with Stage(spark) as stage:
        letters = harvest(repos, paged, unique_urls=True, listing_responses=listed, stage=stage).dead_letters
        return checkpointed(letters.select("repo", "scope", "outcome", F.col("url_pos").cast("bigint").alias("within")))


@query("""
SELECT 'kept-' || n AS file_name, s_suppkey AS item, '{"id":' || s_suppkey || '}' AS entry, 2::BIGINT AS versions
FROM (SELECT s_suppkey, s_suppkey % 5 AS n FROM supplier)
""")
def publish_runs(spark, sf_dir):
    # Two runs are published and one fails: readers see the two, and the entries of the last.
    root = f"{shared_folder(spark)}/publish-{uuid.uuid4()}"
    rows = table(spark, sf_dir, "supplier").select("s_suppkey")
    outputs = rows.select(
        F.lit("r").alias("repo"),
        text("kept-", F.col("s_suppkey") % 5).alias("file_name"),
        F.col("s_suppkey").alias("url_pos"),
        text('{"id":', F.col("s_suppkey"), "}").alias("entry"),
    )
    files = outputs.groupBy("repo", "file_name").agg(F.count(F.lit(1)).alias("row_count")).withColumns({"url": F.lit("http://r"), "published": F.lit(True)})
    landed = outputs.select(text("http://r/", F.col("url_pos")).alias("url"), F.lit(200).alias("status"), F.encode("entry", "utf-8").alias("body"), F.lit(None).cast("string").alias("net_error"))
    try:
        landed.write.parquet(f"{root}/landed")
        again = read_responses(spark, f"{root}/landed").select(F.decode("body", "utf-8").alias("entry"))
        fine = spark.createDataFrame([], "problem string")
        for day, errors in ((1, fine), (2, spark.createDataFrame([("bad",)], "problem string")), (3, fine)):
            try:
                publish(outputs, files, errors, f"{root}/versions", datetime(2024, 1, day, tzinfo=UTC))
            except RunFailed:
                continue
        names = read_snapshots(spark, f"{root}/versions").groupBy("file_name").agg(F.count(F.lit(1)).alias("versions"))
        last = [read_snapshot(spark, f"{root}/versions", datetime(2024, 1, 3, tzinfo=UTC), f"kept-{n}") for n in range(5)]
        seen = reduce(lambda a, b: a.unionByName(b), last).join(again, "entry", "left_semi").join(names, "file_name")
        return checkpointed(seen.select("file_name", F.col("url_pos").alias("item"), "entry", "versions"))
    finally:
        remove(spark, root)


@query(f"""
SELECT 'publisso' AS repo_name, 'publisso-' || part AS listed_as, count(*)::BIGINT AS valid_entries, 0::BIGINT AS failed_entries, false AS skipped
FROM (SELECT p_partkey // {PARTS_PER_LISTING} AS part FROM part) GROUP BY part
""")
def reshape_reports(spark, sf_dir):
    repos, responses = inline_inputs(spark, sf_dir)
    done = harvest(repos, responses)
    report = final_report(done.reports, done.entries)
    names = repos.select("repo_pos", F.col("name").alias("listed_as"))
    return report.join(names, "repo_pos").select("repo_name", "listed_as", "valid_entries", "failed_entries", "skipped")


@query(CRAWL_SQL)
def incremental_crawl(spark, sf_dir):
    # Half of the pages land first, along with failures of others; the rest, and those again, before the second run.
    repos, listed, paged = crawl_inputs(spark, sf_dir)
    root = f"{shared_folder(spark)}/incremental-{uuid.uuid4()}"
    key = F.xxhash64("url") % 4
    late = F.timestamp_seconds(F.lit(1_700_086_400))
    early = F.timestamp_seconds(F.lit(1_700_000_000))
    failures = paged.where(key == 3).withColumns({"status": F.lit(500), "body": F.lit(None).cast("binary")})
    first = paged.where(key < 2).unionByName(failures).withColumn("landed_at", early)
    second = paged.where(~F.coalesce(key < 2, F.lit(False))).withColumn("landed_at", late)
    try:
        for landed in (first, second):
            landed.write.mode("append").parquet(f"{root}/landed")
            advance(extracted_responses(stream_responses(spark, f"{root}/landed")), f"{root}/run")
        pages = read_extracted(spark, f"{root}/run")
        with Stage(spark) as stage:
            done = harvest(repos, pages, listing_responses=listed, stage=stage, extracted=True)
            return checkpointed(_report(final_report(done.reports, done.entries)))
    finally:
        remove(spark, root)


@query("""
WITH rows AS (SELECT p_partkey AS k, 'file-' || p_partkey % 3 AS file_name, CASE WHEN p_partkey % 11 = 0 THEN 2 ELSE 1 END AS copies FROM part)
SELECT file_name, k::VARCHAR AS identity,
       CASE WHEN k % 7 = 0 THEN 0 ELSE copies - 1 END::BIGINT AS added,
       CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END::BIGINT AS removed,
       CASE WHEN k % 7 <> 0 AND k % 5 = 0 THEN 1 ELSE 0 END::BIGINT AS changed
FROM rows WHERE k % 7 = 0 OR k % 5 = 0 OR copies = 2
UNION ALL
SELECT file_name, 'n' || k, 1, 0, 0 FROM rows WHERE k % 13 = 0
""")
def changed_entries(spark, sf_dir):
    # Two published runs: the second has lost some records, changed some, doubled some, and has new ones.
    root = f"{shared_folder(spark)}/changes-{uuid.uuid4()}"
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", text("file-", key % 3).alias("file_name"))
    names = F.array(F.when(key % 7 != 0, key.cast("string")), F.when((key % 7 != 0) & (key % 11 == 0), key.cast("string")), F.when(key % 13 == 0, text("n", key)))
    later = rows.withColumn("id", F.explode(F.array_compact(names)))
    price = F.when((key % 5 == 0) & (F.col("id") == key.cast("string")), 2).otherwise(1)
    versions = [rows.withColumn("id", key.cast("string")).withColumn("price", F.lit(1)), later.withColumn("price", price)]
    days = [datetime(2024, 1, day, tzinfo=UTC) for day in (1, 2)]
    try:
        for version, day in zip(versions, days, strict=True):
            outputs = version.select(
                F.lit("r").alias("repo"), "file_name", key.alias("url_pos"), F.to_json(F.struct("id", "p_name", "price")).alias("entry")
            )
            files = outputs.groupBy("repo", "file_name").agg(F.count(F.lit(1)).alias("row_count"))
            files = files.withColumns({"url": F.lit("http://r"), "published": F.lit(True)})
            publish(outputs, files, spark.createDataFrame([], "problem string"), f"{root}/versions", day)
        old, new = (reduce(DataFrame.unionByName, [read_snapshot(spark, f"{root}/versions", day, f"file-{n}") for n in range(3)]) for day in days)
        return checkpointed(version_changes(old, new, F.get_json_object("entry", "$.id")))
    finally:
        remove(spark, root)
