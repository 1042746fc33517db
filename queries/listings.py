"""Queries on listings: XML sitemaps, id lists and inline records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from queries.corpora import (
    ORDERS_PER_LISTING,
    PAGES_PER_LISTING,
    PARTS_PER_LISTING,
    SUPPLIERS_PER_LISTING,
    id_listings,
    inline_listings,
    nested_listings,
    xml_listings,
)
from queries.registry import ORACLES, query
from sheaf.operators.extract import EXTRACTORS
from sheaf.operators.listings import dataset_urls, inline_entries, listing_rows, member_entries, member_urls, parse_listings


def configured(listings, sitemap, metadata=None):
    return listings.withColumns(
        {"sitemap": F.lit(sitemap), "metadata": F.lit(metadata).cast("string")}
    )


def listed_urls(listings, sitemap):
    parsed = parse_listings(configured(listings, sitemap, "jsonld"))
    return dataset_urls(parsed).select("repo", F.col("url_pos").cast("bigint").alias("url_pos"), "url")


def listed_records(listings, sitemap, schema, *fields):
    entries = inline_entries(parse_listings(configured(listings, sitemap)))
    entries = entries.withColumn("record", F.from_json("entry", schema))
    return entries.select(
        "repo", F.col("item_pos").cast("bigint").alias("item_pos"),
        *(F.col(f"record.{field}").alias(field) for field in fields),
    )


@query(f"""
SELECT 'pages-' || part AS repo,
       (row_number() OVER (PARTITION BY part ORDER BY page_id) - 1)::BIGINT AS url_pos,
       CASE WHEN page_id % 2 = 0 THEN chr(10) || '    ' || url || chr(10) || '  ' ELSE url END AS url
FROM (SELECT *, page_id // {PAGES_PER_LISTING} AS part FROM pages) WHERE part % 7 <> 3
""")
def sitemap_xml_urls(spark, sf_dir):
    return listed_urls(xml_listings(spark, sf_dir), "xml")


@query(f"""
SELECT 'orders-' || part AS repo,
       (row_number() OVER (PARTITION BY part ORDER BY o_orderkey) - 1)::BIGINT AS url_pos,
       'https://www.openagrar.de/receive/'
       || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus || '_' END || o_orderkey AS url
FROM (SELECT *, o_orderkey // {ORDERS_PER_LISTING} AS part FROM orders) WHERE part % 11 <> 5
""")
def sitemap_id_urls(spark, sf_dir):
    return listed_urls(id_listings(spark, sf_dir), "openagrar")


@query(f"""
SELECT 'suppliers-' || part AS repo,
       (row_number() OVER (PARTITION BY part ORDER BY s_suppkey) - 1)::BIGINT AS item_pos,
       s_suppkey, s_name
FROM (SELECT *, s_suppkey // {SUPPLIERS_PER_LISTING} AS part FROM supplier)
WHERE part % 9 NOT IN (4, 7)
UNION ALL
SELECT DISTINCT 'suppliers-' || s_suppkey // {SUPPLIERS_PER_LISTING}, 0, NULL::BIGINT,
       'group ' || s_suppkey // {SUPPLIERS_PER_LISTING}
FROM supplier WHERE s_suppkey // {SUPPLIERS_PER_LISTING} % 9 = 4
""")
def inline_records(spark, sf_dir):
    return listed_records(
        inline_listings(spark, sf_dir), "publisso", "s_suppkey BIGINT, s_name STRING", "s_suppkey", "s_name"
    )


@query(f"""
SELECT 'parts-' || part AS repo,
       (row_number() OVER (PARTITION BY part ORDER BY p_partkey) - 1)::BIGINT AS item_pos,
       p_partkey, p_name
FROM (SELECT *, p_partkey // {PARTS_PER_LISTING} AS part FROM part) WHERE part % 8 NOT IN (3, 6)
UNION ALL
SELECT DISTINCT 'parts-' || p_partkey // {PARTS_PER_LISTING}, 0, NULL::BIGINT,
       'group ' || p_partkey // {PARTS_PER_LISTING}
FROM part WHERE p_partkey // {PARTS_PER_LISTING} % 8 = 6
""")
def inline_nested(spark, sf_dir):
    return listed_records(
        nested_listings(spark, sf_dir), "thunen_atlas", "p_partkey BIGINT, p_name STRING", "p_partkey", "p_name"
    )


@query(f"""
SELECT sitemap, mode, scope, count(*)::BIGINT AS n_listings, sum(n)::BIGINT AS n_items FROM (
  SELECT 'xml' AS sitemap, CASE WHEN part % 7 = 3 THEN 'none' ELSE 'crawl' END AS mode,
         CASE WHEN part % 7 = 3 THEN 'repo' END AS scope, CASE WHEN part % 7 = 3 THEN 0 ELSE n END AS n
  FROM (SELECT page_id // {PAGES_PER_LISTING} AS part, count(*) AS n FROM pages GROUP BY 1)
  UNION ALL
  SELECT 'openagrar', 'none', CASE WHEN part % 11 = 5 THEN 'repo' END,
         CASE WHEN part % 11 = 5 THEN 0 ELSE n END
  FROM (SELECT o_orderkey // {ORDERS_PER_LISTING} AS part, count(*) AS n FROM orders GROUP BY 1)
  UNION ALL
  SELECT 'publisso', CASE WHEN part % 9 = 7 THEN 'none' ELSE 'inline' END,
         CASE WHEN part % 9 = 7 THEN 'repo' END,
         CASE part % 9 WHEN 7 THEN 0 WHEN 4 THEN 1 ELSE n END
  FROM (SELECT s_suppkey // {SUPPLIERS_PER_LISTING} AS part, count(*) AS n FROM supplier GROUP BY 1)
  UNION ALL
  SELECT 'thunen_atlas', CASE WHEN part % 8 = 3 THEN 'none' ELSE 'inline' END,
         CASE WHEN part % 8 = 3 THEN 'run' END,
         CASE part % 8 WHEN 3 THEN 0 WHEN 6 THEN 1 ELSE n END
  FROM (SELECT p_partkey // {PARTS_PER_LISTING} AS part, count(*) AS n FROM part GROUP BY 1)
  UNION ALL
  SELECT 'oai', 'none', 'run', 0 FROM (SELECT DISTINCT page_id // {PAGES_PER_LISTING} FROM pages)
) GROUP BY 1, 2, 3
""")
def sitemap_dispatch(spark, sf_dir):
    listings = [
        configured(xml_listings(spark, sf_dir), "xml", "jsonld"),
        configured(id_listings(spark, sf_dir), "openagrar"),
        configured(inline_listings(spark, sf_dir), "publisso", "not looked at"),
        configured(nested_listings(spark, sf_dir), "thunen_atlas"),
        configured(xml_listings(spark, sf_dir), "oai", "jsonld"),
    ]
    whole = reduce(lambda a, b: a.unionByName(b), listings)
    parsed = parse_listings(whole, extractor_keys=tuple(EXTRACTORS))
    found = F.coalesce(F.size("urls"), F.size("items"), F.lit(0)).cast("bigint")
    return parsed.groupBy("sitemap", "mode", "scope").agg(
        F.count(F.lit(1)).alias("n_listings"), F.sum(found).alias("n_items")
    )


@query(f"""
SELECT repo, url_pos AS position, url AS member FROM ({ORACLES["sitemap_xml_urls"]})
UNION ALL SELECT repo, url_pos, url FROM ({ORACLES["sitemap_id_urls"]})
UNION ALL SELECT repo, item_pos, s_name FROM ({ORACLES["inline_records"]})
UNION ALL SELECT repo, item_pos, p_name FROM ({ORACLES["inline_nested"]})
""")
def listing_members(spark, sf_dir):
    # All kinds in one pass, each member a row as its listing is read.
    listings = [
        configured(xml_listings(spark, sf_dir), "xml", "jsonld"),
        configured(id_listings(spark, sf_dir), "openagrar", "jsonld"),
        configured(inline_listings(spark, sf_dir), "publisso"),
        configured(nested_listings(spark, sf_dir), "thunen_atlas"),
    ]
    rows = listing_rows(reduce(lambda a, b: a.unionByName(b), listings), extractor_keys=tuple(EXTRACTORS))
    urls = member_urls(rows).select("repo", F.col("url_pos").cast("bigint").alias("position"), F.col("url").alias("member"))
    names = F.from_json("entry", "s_name STRING, p_name STRING")
    records = member_entries(rows).withColumn("names", names)
    return urls.unionByName(
        records.select("repo", F.col("item_pos").cast("bigint").alias("position"), F.coalesce("names.s_name", "names.p_name").alias("member"))
    )
