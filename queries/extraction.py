"""Queries on JSON-LD extraction and canonical JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.corpora import VARIANT_SQL, embedded_pages, standalone_documents, table, text
from queries.registry import query
from sheaf.functions.html import jsonld_blocks
from sheaf.functions.json import with_records
from sheaf.operators.extract import EXTRACTORS, dead_letters, extract_by_key, flatten_entries
from sheaf.sources.splits import spread_rows

ESCAPED_SQL = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
BAD_SQL = f"'{{\"@id\": doc-' || doc_id || ', ' || {ESCAPED_SQL}"
DATASET = "`@id` STRING, name STRING, description STRING"


FIRST_SQL = """replace('{"@context":"https://schema.org","@type":"Dataset","@id":"doc-' || doc_id || '","name":"' || lang || ' ' || doc_id
|| '","description":' || to_json(text)::VARCHAR || '}', '</', '<\\/')"""
SECOND_SQL = """('{"@context":"https://schema.org","@type":"Dataset","@id":"doc-' || doc_id || '-b","name":"' || lang || ' ' || doc_id || ' b"}')"""


@query(f"""
SELECT doc_id, unnest(range(len(blocks)))::BIGINT AS block_pos, unnest(blocks) AS block
FROM (SELECT doc_id, CASE v WHEN 1 THEN [{BAD_SQL}] WHEN 2 THEN ['[' || {FIRST_SQL} || ',' || chr(10) || {SECOND_SQL} || ']']
        WHEN 3 THEN [' ' || chr(10) || ' '] WHEN 4 THEN [{FIRST_SQL}, {SECOND_SQL}]
        WHEN 5 THEN ['{{"@id":"doc-' || doc_id || '"}}', {BAD_SQL}]
        WHEN 0 THEN [] WHEN 7 THEN [] ELSE [{FIRST_SQL}] END AS blocks
      FROM (SELECT *, {VARIANT_SQL} AS v FROM documents))
""")
def jsonld_raw_blocks(spark, sf_dir):
    pages = embedded_pages(spark, sf_dir).withColumn("blocks", jsonld_blocks(F.col("content")))
    blocks = pages.select("doc_id", F.posexplode("blocks").alias("block_pos", "block"))
    return blocks.withColumn("block_pos", F.col("block_pos").cast("bigint"))


ENTRIES_SQL = f"""
SELECT doc_id, 0::BIGINT AS item_pos, 'doc-' || doc_id AS ident, lang || ' ' || doc_id AS name,
       text AS description
FROM documents WHERE {VARIANT_SQL} IN (2, 4, 6, 8, 9)
UNION ALL
SELECT doc_id, 1, 'doc-' || doc_id || '-b', lang || ' ' || doc_id || ' b', NULL
FROM documents WHERE {VARIANT_SQL} IN (2, 4)
"""


def extracted_pages(spark, sf_dir):
    pages = embedded_pages(spark, sf_dir).withColumn("metadata", F.lit("embedded_jsonld"))
    return extract_by_key(pages)


@query(ENTRIES_SQL)
def jsonld_entries(spark, sf_dir):
    entries = flatten_entries(extracted_pages(spark, sf_dir))
    entries = entries.withColumn("record", F.from_json("entry", DATASET))
    return entries.select(
        F.col("url_pos").alias("doc_id"),
        F.col("item_pos").cast("bigint").alias("item_pos"),
        F.col("record.@id").alias("ident"),
        F.col("record.name").alias("name"),
        F.col("record.description").alias("description"),
    )


PLAIN_SQL = "'{\"id\":' || c_custkey || ',\"name\":\"' || c_name || '\"}'"
DOCUMENTS_SQL = f"""
SELECT c_custkey, 0::BIGINT AS item_pos,
       CASE c_custkey % 10 WHEN 5 THEN c_custkey::VARCHAR
            WHEN 6 THEN '{{"n":' || c_custkey || '.5,"name":"üé"}}'
            ELSE {PLAIN_SQL} END AS entry
FROM customer WHERE c_custkey % 10 NOT IN (0, 1, 2)
UNION ALL
SELECT c_custkey, 1, '{{"id":0}}' FROM customer WHERE c_custkey % 10 = 3
"""


@query(DOCUMENTS_SQL)
def jsonld_documents(spark, sf_dir):
    documents = standalone_documents(spark, sf_dir).withColumn("metadata", F.lit("jsonld"))
    entries = flatten_entries(extract_by_key(documents))
    return entries.select(
        F.col("url_pos").alias("c_custkey"), F.col("item_pos").cast("bigint").alias("item_pos"), "entry"
    )


@query("""
SELECT c_custkey, c_custkey % 10 >= 3 AS parsed, 1::BIGINT AS n_raw,
       CASE c_custkey % 10 WHEN 0 THEN left(plain, 12) WHEN 1 THEN plain || ' x' WHEN 2 THEN '' WHEN 3 THEN '[' || plain || ',{"id":0}]'
            WHEN 4 THEN '{"id":-1,"name":"' || c_name || '","id":' || c_custkey || '}' WHEN 5 THEN c_custkey::VARCHAR
            WHEN 6 THEN '{"n":' || c_custkey || '.50,"name":"ü\\u00e9"}' ELSE ' ' || plain || chr(10) END AS raw
FROM (SELECT *, '{"name":"' || c_name || '","id":' || c_custkey || '}' AS plain FROM customer)
""")
def jsonld_raw_documents(spark, sf_dir):
    # The raw text of every standalone document, whether it can be parsed or not.
    done = EXTRACTORS["jsonld"](standalone_documents(spark, sf_dir))
    return done.select(
        "c_custkey",
        F.col("entries").isNotNull().alias("parsed"),
        F.size("raw").cast("bigint").alias("n_raw"),
        F.get("raw", F.lit(0)).alias("raw"),
    )


@query(f"""
SELECT 'embedded_jsonld' AS metadata,
       CASE WHEN v IN (1, 3, 5) THEN 'parse' ELSE 'ok' END AS outcome,
       count(*)::BIGINT AS n_documents,
       sum(CASE WHEN v IN (2, 4) THEN 2 WHEN v IN (6, 8, 9) THEN 1 ELSE 0 END)::BIGINT AS n_entries
FROM (SELECT {VARIANT_SQL} AS v FROM documents) GROUP BY 1, 2
UNION ALL
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'microdata' ELSE 'jsonld' END,
       CASE WHEN c_custkey % 4 = 0 THEN 'unknown_key'
            WHEN c_custkey % 10 < 3 THEN 'parse' ELSE 'ok' END,
       count(*),
       sum(CASE WHEN c_custkey % 4 = 0 OR c_custkey % 10 < 3 THEN 0
                WHEN c_custkey % 10 = 3 THEN 2 ELSE 1 END)::BIGINT
FROM customer GROUP BY 1, 2
""")
def extract_dispatch(spark, sf_dir):
    pages = embedded_pages(spark, sf_dir).drop("doc_id")
    pages = pages.withColumn("metadata", F.lit("embedded_jsonld"))
    documents = standalone_documents(spark, sf_dir).withColumn(
        "metadata", F.when(F.col("c_custkey") % 4 == 0, "microdata").otherwise("jsonld")
    )
    done = extract_by_key(pages.unionByName(documents.drop("c_custkey")))
    return done.groupBy("metadata", "outcome").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.coalesce(F.size("entries"), F.lit(0)).cast("bigint")).alias("n_entries"),
    )


@query(f"""
SELECT source AS repo, doc_id, 'parse' AS outcome,
       CASE v WHEN 1 THEN {BAD_SQL} WHEN 3 THEN ' ' || chr(10) || ' '
              ELSE '{{"@id":"doc-' || doc_id || '"}}' || {BAD_SQL} END AS suspicious_data
FROM (SELECT *, {VARIANT_SQL} AS v FROM documents) WHERE v IN (1, 3, 5)
""")
def dead_letter(spark, sf_dir):
    letters = dead_letters(extracted_pages(spark, sf_dir))
    return letters.select("repo", F.col("url_pos").alias("doc_id"), "outcome", "suspicious_data")


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       '{"A":[' || l_suppkey || ',{"b":null,"ä":"' || l_shipdate::DATE || '"}],"a":{"flag":"'
       || l_returnflag || '","status":"' || l_linestatus || '"},"part":' || l_partkey
       || ',"ü\\\\":true' || CASE WHEN l_orderkey % 50 = 0 THEN ',"￮":1,"😀":2' ELSE '' END || '}' AS entry
FROM lineitem
""")
def canonical_json(spark, sf_dir):
    lines = spread_rows(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"
        )
    )
    content = text(
        '{ "part" : ', F.col("l_partkey"), ',\n"a":{"status":"', F.col("l_linestatus"), '","flag":"',
        F.col("l_returnflag"), '"},"\\u00fc\\\\":true, "A":[', F.col("l_suppkey"),
        ' , {"\\u00e4":"', F.col("l_shipdate").cast("date"), '","b":null}]',
        F.when(F.col("l_orderkey") % 50 == 0, ', "😀":2,"￮" : 1}').otherwise("}"),
    )
    parsed = with_records(lines.withColumn("content", content), "content", "records")
    return parsed.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.get("records.items", F.lit(0)).alias("entry"),
    )
