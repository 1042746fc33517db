"""Harvest inputs derived from the given tables.

The tables hold no listings, JSON-LD or repository records, so these are built from their rows: one
derived object per row, with the variant chosen by the key. Listings group a fixed range of a unique
key, which bounds their size whatever the distribution of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.sources.splits import spread_rows

# Rows of a listing.
DOCS_PER_LISTING = 50
PAGES_PER_LISTING = 20
ORDERS_PER_LISTING = 100
SUPPLIERS_PER_LISTING = 10
PARTS_PER_LISTING = 50
CUSTOMERS_PER_LISTING = 50

SITEMAP_HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    """Concatenation of columns and literal strings."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def escaped(column: Column) -> Column:
    """Text for the body of an HTML or XML element."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(plain), F.lit(entity))
    return column


def block_range(key: str, size: int) -> Column:
    return F.floor(F.col(key) / size).cast("bigint")


def joined(df: DataFrame, group: str, key: str, part: Column, separator: str) -> DataFrame:
    """``(group, listing)``: the parts of one key range in key order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), part.alias("part"))))
    grouped = df.groupBy(group).agg(parts.alias("parts"))
    return grouped.select(group, F.array_join(F.col("parts.part"), separator).alias("listing"))


# --- pages with embedded JSON-LD --------------------------------------------------------------------

# The same rule in SQL, for the oracles.
VARIANT_SQL = "((doc_id + doc_id // 20) % 10)"


def variant() -> Column:
    """0 no block, 1 bad block, 2 list of two, 3 blank block, 4 two blocks, 5 good and bad block,
    6 upper-case tag with single quotes, 7 block in a comment and a plain script, 8 and 9 one object."""
    return (F.col("doc_id") + F.floor(F.col("doc_id") / 20)) % 10


def embedded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, repo, url_pos, url, content)``: one HTML page per document, with its whole text."""
    docs = spread_rows(
        table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    )
    ident = text("doc-", F.col("doc_id"))
    name = text(F.col("lang"), " ", F.col("doc_id"))
    common = [F.lit("https://schema.org").alias("@context"), F.lit("Dataset").alias("@type")]
    first = F.to_json(
        F.struct(*common, ident.alias("@id"), name.alias("name"), F.col("text").alias("description"))
    )
    first = F.replace(first, F.lit("</"), F.lit("<\\/"))
    second = F.to_json(F.struct(*common, text(ident, "-b").alias("@id"), text(name, " b").alias("name")))
    short = text('{"@id":"', ident, '"}')
    bad = text('{"@id": doc-', F.col("doc_id"), ", ", escaped(F.col("text")))

    def script(body: Column) -> Column:
        return text('<script type="application/ld+json">', body, "</script>\n")

    v = variant()
    blocks = (
        F.when(v == 0, "")
        .when(v == 1, script(bad))
        .when(v == 2, script(text("[", first, ",\n", second, "]")))
        .when(v == 3, script(F.lit(" \n ")))
        .when(v == 4, text(script(first), script(second)))
        .when(v == 5, text(script(short), script(bad)))
        .when(v == 6, text("<SCRIPT async TYPE='application/ld+json'>", first, "</SCRIPT>"))
        .when(
            v == 7,
            text(
                "<!-- ", script(F.replace(first, F.lit("-->"), F.lit("--\\u003e"))),
                " --><script>var x = '<!--';</script>",
            ),
        )
        .otherwise(script(first))
    )
    html = text(
        "<html><head><title>", escaped(name), "</title>\n", blocks, "</head><body><p>",
        escaped(F.col("text")), "</p></body></html>",
    )
    return docs.select(
        "doc_id",
        F.col("source").alias("repo"),
        F.col("doc_id").alias("url_pos"),
        text("https://data.example.org/page/", F.col("doc_id")).alias("url"),
        html.alias("content"),
    )


# --- listings ---------------------------------------------------------------------------------------


def xml_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, content)``: one sitemap per range of pages; every seventh is cut off."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pages = pages.withColumn("part", block_range("page_id", PAGES_PER_LISTING))
    loc = F.when(
        F.col("page_id") % 2 == 0, text("\n    ", escaped(F.col("url")), "\n  ")
    ).otherwise(escaped(F.col("url")))
    entry = text("\n<url><loc>", loc, "</loc><lastmod>2024-01-01</lastmod></url>")
    whole = joined(pages, "part", "page_id", entry, "")
    end = F.when(F.col("part") % 7 == 3, "</url").otherwise("<url><loc/></url></urlset>")
    return whole.select(
        text("pages-", F.col("part")).alias("name"),
        text(SITEMAP_HEAD, F.col("listing"), end).alias("content"),
    )


def id_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, content)``: one id list per range of orders; every eleventh lacks an id."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    orders = orders.withColumn("part", block_range("o_orderkey", ORDERS_PER_LISTING))
    key = F.col("o_orderkey")
    lacking = (F.col("part") % 11 == 5) & (key % ORDERS_PER_LISTING == 7)
    doc = (
        F.when(lacking, text('{"no_id":', key, "}"))
        .when(key % 5 == 0, text('{"id":', key, "}"))
        .otherwise(text('{"id":"', F.col("o_orderstatus"), "_", key, '","n":', key, "}"))
    )
    whole = joined(orders, "part", "o_orderkey", doc, ",")
    return whole.select(
        text("orders-", F.col("part")).alias("name"),
        text('{"response":{"docs":[', F.col("listing"), "]}}").alias("content"),
    )


def inline_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, content)``: a list of suppliers, a lone object (4 of 9) or a bad text (7 of 9)."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = rows.withColumn("part", block_range("s_suppkey", SUPPLIERS_PER_LISTING))
    record = F.to_json(F.struct("s_suppkey", "s_nationkey", "s_name"))
    whole = joined(rows, "part", "s_suppkey", record, ", ")
    records = text("[", F.col("listing"), "]")
    content = (
        F.when(F.col("part") % 9 == 4, text('{"s_name":"group ', F.col("part"), '"}'))
        .when(F.col("part") % 9 == 7, text(records, " and more"))
        .otherwise(records)
    )
    return whole.select(text("suppliers-", F.col("part")).alias("name"), content.alias("content"))


def nested_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, content)``: parts under ``resources``; the key is missing in 3 of 8, one object in 6 of 8."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    rows = rows.withColumn("part", block_range("p_partkey", PARTS_PER_LISTING))
    record = F.to_json(F.struct("p_size", "p_partkey", "p_name"))
    whole = joined(rows, "part", "p_partkey", record, ",")
    records = text("[", F.col("listing"), "]")
    content = (
        F.when(F.col("part") % 8 == 3, text('{"items":', records, "}"))
        .when(F.col("part") % 8 == 6, text('{"resources":{"p_name":"group ', F.col("part"), '"}}'))
        .otherwise(text('{"total":1,"resources":', records, "}"))
    )
    return whole.select(text("parts-", F.col("part")).alias("name"), content.alias("content"))


# --- standalone documents ---------------------------------------------------------------------------


def standalone_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(c_custkey, repo, url_pos, url, content)``: JSON documents, good and bad by key."""
    rows = spread_rows(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    )
    key = F.col("c_custkey")
    plain = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")))
    v = key % 10
    content = (
        F.when(v == 0, F.substring(plain, 1, 12))
        .when(v == 1, text(plain, " x"))
        .when(v == 2, "")
        .when(v == 3, text("[", plain, ',{"id":0}]'))
        .when(v == 4, text('{"id":-1,"name":"', F.col("c_name"), '","id":', key, "}"))
        .when(v == 5, text(key))
        .when(v == 6, text('{"n":', key, '.50,"name":"ü\\u00e9"}'))
        .otherwise(text(" ", plain, "\n"))
    )
    return rows.select(
        "c_custkey",
        F.col("c_mktsegment").alias("repo"),
        key.alias("url_pos"),
        text("https://data.example.org/doc/", key).alias("url"),
        content.alias("content"),
    )


# --- responses --------------------------------------------------------------------------------------


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(repo, url_pos, url)``: each event asks for a URL.

    A third of all rows belongs to one repository and asks for the same URL.
    """
    rows = table(spark, sf_dir, "events").select("event_id")
    event = F.col("event_id")
    url = F.when(event % 3 == 0, text("https://api.example.org/hot")).otherwise(
        text("https://api.example.org/event/", event)
    )
    return rows.select(
        F.when(event % 3 == 0, "big").otherwise(text("r", F.floor(event / 8))).alias("repo"),
        event.alias("url_pos"),
        url.alias("url"),
    )


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, url, status, body, net_error)``: a response to each event, with errors by type and key."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "props", "ts")
    event = F.col("event_id")
    failed = F.col("event_type") == "error"
    status = (
        F.when(failed & (event % 5 == 0), 500)
        .when(failed & (event % 5 == 1), F.lit(None))
        .when(failed, 404)
        .otherwise(200)
    )
    body = F.encode(text(F.col("props"), " ", event), "utf-8")
    url = F.when(event % 3 == 0, text("https://api.example.org/hot")).otherwise(
        text("https://api.example.org/event/", event)
    )
    hot = event % 3 == 0
    return rows.select(
        "event_id",
        url.alias("url"),
        F.when(hot, 200).otherwise(status).cast("int").alias("status"),
        F.when(hot, F.encode(F.lit("hot"), "utf-8")).otherwise(
            F.when(event % 10 == 4, F.concat(body, F.lit(bytearray(b"\xff")))).otherwise(body)
        ).alias("body"),
        F.when(~hot & failed & (event % 5 == 1), "reset").alias("net_error"),
    )


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed of :func:`event_responses`: every 13th never did."""
    return event_responses(spark, sf_dir).where(F.col("event_id") % 13 != 1).drop("event_id")


# --- records for the split and the reshape ----------------------------------------------------------


def publisher_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(repo, url_pos, item_pos, entry)``: customers with a publisher spelled by key."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    key = F.col("c_custkey")
    return rows.select(
        F.col("c_mktsegment").alias("repo"),
        key.alias("url_pos"),
        F.lit(0).alias("item_pos"),
        publisher_entry(key, F.col("c_name")).alias("entry"),
    )


def publisher_entry(key: Column, name: Column) -> Column:
    spelled = (
        F.when(key % 7 == 0, "Johann Heinrich von Thünen-Institut")
        .when(key % 7 == 1, "THUENEN INSTITUTE")
        .when(key % 7 == 2, "thünen-atlas, Braunschweig")
        .when(key % 7 == 3, "THÜNEN INSTITUT")
        .when(key % 7 == 4, "Thunen Institute")
    )
    publisher = (
        F.when(key % 7 == 5, '{"url":null}')
        .when(key % 7 != 6, text('{"name":"', spelled, '"}'))
    )
    return json_object(
        ("name", text('"', name, '"')), ("publisher", publisher), ("id", text(key))
    )


def json_object(*fields: tuple[str, Column]) -> Column:
    """JSON text of an object; a field whose text is NULL is absent."""
    members = [F.when(value.isNotNull(), text(f'"{key}":', value)) for key, value in fields]
    return text("{", F.concat_ws(",", *members), "}")


def json_list(count: Column, member) -> Column:
    """JSON text of a list with ``count`` members, ``member(i)`` being the text of the i-th."""
    numbers = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return text("[", F.array_join(F.transform(numbers, member), ","), "]")


def fanout_records(spark: SparkSession, sf_dir: str, repaired: Column | None = None) -> DataFrame:
    """Records from parts with 0 to 3 titles, descriptions and licences, some lists absent.

    A record without doi and id (every sixth, from 3 on) cannot be reshaped; those that are ``repaired`` have a doi.
    """
    rows = spread_rows(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    )
    key = F.col("p_partkey")
    doi = F.when(key % 3 != 0, F.when(key % 17 == 0, "null").otherwise(text('"10.4126/', key, '"')))
    if repaired is not None:
        doi = F.when(repaired & (key % 6 == 3), text('"10.4126/', key, '"')).otherwise(doi)
    inner = F.when(key % 2 == 0, text('"frl:', key, '"'))
    titles = F.when(
        key % 20 != 0, json_list(key % 4, lambda i: text('"title ', key, ".", i, '"'))
    )
    descriptions = F.when(
        key % 7 != 0, json_list(key % 3, lambda i: text('"about ', key, ".", i, '"'))
    )
    licences = F.when(
        key % 11 != 0, json_list(key % 5, lambda i: text('{"@id":"licence-', i, '"}'))
    )
    entry = json_object(
        ("doi", doi),
        ("@id", inner),
        ("title", titles),
        ("description", descriptions),
        ("license", licences),
        ("alternative", F.when(key % 4 < 2, text('["', F.col("p_name"), '","other"]'))),
        ("yearOfCopyright", F.when(key % 4 == 1, "[]").when(key % 4 == 2, text("[", F.col("p_size"), "]"))),
        ("issued", F.when(key % 5 != 0, text('"', F.col("p_size") + 1950, '"'))),
    )
    return rows.select(
        "p_partkey",
        F.col("p_brand").alias("repo"),
        key.alias("url_pos"),
        F.lit(0).alias("item_pos"),
        entry.alias("entry"),
    )


def people_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from orders whose creator is the customer and whose terms follow the key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # Dealt out behind the join: its short rows fit into few tasks, in which all that follows would be done.
    rows = spread_rows(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), rows=orders.count())
    key = F.col("o_orderkey")
    label = (
        F.when(key % 4 == 0, F.col("c_name"))
        .when(key % 4 == 1, text(F.col("c_name"), ", Ada"))
        .when(key % 4 == 2, text(F.col("c_name"), ", Ada, M."))
        .otherwise("")
    )

    def thing(prefix: str, name: Column | None = None) -> Column:
        return json_object(
            ("@id", text(f'"{prefix}:', key, '"')),
            ("prefLabel", F.lit("null") if name is None else text('"', name, '"')),
        )

    entry = json_object(
        ("doi", text('"10.1/', key, '"')),
        ("creator", F.when(key % 3 != 0, text("[", thing("p", label), "]"))),
        ("contributor", F.when(key % 3 == 0, text("[", thing("q", label), ",", thing("r", label), "]"))),
        ("institution", F.when(key % 2 == 0, text("[", thing("i", F.col("c_mktsegment")), "]"))),
        ("ddc", json_list(key % 3, lambda i: text('{"@id":"ddc-', i, '"}'))),
        ("subject", json_list(key % 2, lambda i: text('{"prefLabel":"subject ', i, '"}'))),
        ("dataOrigin", F.when(key % 5 == 0, text("[", thing("o"), ",null]"))),
        ("fundingId", json_list(key % 4, lambda i: thing("f", text(i)))),
        ("joinedFunding", F.when(key % 6 == 0, text('[{"fundingProgramJoined":"prog ', key, '","fundingJoined":', thing("g", F.lit("org")), "}]"))),
        ("fundingProgram", F.when(key % 2 == 0, text('["program ', key, '"]'))),
        ("hasPart", F.when(key % 4 == 1, text('[{"@id":null,"prefLabel":"data.csv"},', thing("part"), "]"))),
        ("language", F.when(key % 5 == 1, text("[", thing("lang", F.lit("Deutsch")), "]"))),
        ("recordingCoordinates", F.when(key % 7 == 0, text('[{"@id":"geo:', key, '"}]'))),
        ("recordingLocation", F.when(key % 7 < 2, text("[", thing("loc", F.lit("Field")), "]"))),
    )
    return rows.select(
        F.col("o_orderpriority").alias("repo"),
        key.alias("url_pos"),
        F.lit(0).alias("item_pos"),
        entry.alias("entry"),
        "o_orderkey",
    )


# --- whole harvests ---------------------------------------------------------------------------------


def _answer(url: Column, body: Column, status: Column | None = None) -> list[Column]:
    return [
        url.alias("url"),
        (F.lit(200) if status is None else status).cast("int").alias("status"),
        body.alias("body"),
        F.lit(None).cast("string").alias("net_error"),
    ]


def crawl_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalog, responses to listings, and to pages: one repository per range of documents, crawled by sitemap.

    By number of the repository modulo 10: 6 has a page that fails with a server error, 7 a listing
    that is not found, 8 a listing that is cut off, 9 no extractor.
    """
    pages = embedded_pages(spark, sf_dir).drop("repo")
    pages = pages.withColumn("part", block_range("doc_id", DOCS_PER_LISTING))
    # Catalog and listings need no more than the ids.
    ids = table(spark, sf_dir, "documents").select("doc_id", block_range("doc_id", DOCS_PER_LISTING).alias("part"))
    within = F.col("doc_id") % DOCS_PER_LISTING
    part = F.col("part")
    loc = text("<url><loc>https://data.example.org/page/", F.col("doc_id"), "</loc></url>")
    listings = joined(ids, "part", "doc_id", loc, "\n")
    listing_url = text("https://lists.example.org/", part)
    end = F.when(part % 10 == 8, "").otherwise("</urlset>")
    listed = listings.select(
        *_answer(
            listing_url,
            F.encode(text(SITEMAP_HEAD, F.col("listing"), end), "utf-8"),
            F.when(part % 10 == 7, 404).otherwise(200),
        )
    )
    body = F.encode(F.col("content"), "utf-8")
    status = F.when((part % 10 == 6) & (within == 3), 503).when(within == 4, 404).otherwise(200)
    paged = pages.select(
        *_answer(
            F.col("url"),
            F.when(within == 5, F.concat(body, F.lit(bytearray(b"\xff")))).otherwise(body),
            status,
        )
    )
    repos = ids.select("part").distinct().select(
        part.cast("int").alias("repo_pos"),
        text("repo-", part).alias("name"),
        listing_url.alias("url"),
        F.lit("xml").alias("sitemap"),
        F.when(part % 10 != 9, "embedded_jsonld").alias("metadata"),
        F.lit(True).alias("commit"),
    )
    return repos, listed, paged


def inline_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Catalog and responses: one repository per range of parts, whose listing holds the records.

    All records of repositories with an even number can be reshaped.
    """
    part = block_range("p_partkey", PARTS_PER_LISTING)
    records = fanout_records(spark, sf_dir, repaired=part % 2 == 0).withColumn("part", part)
    part = F.col("part")
    listing_url = text("https://records.example.org/", part)
    listed = joined(records, "part", "p_partkey", F.col("entry"), ",").select(
        *_answer(listing_url, F.encode(text("[", F.col("listing"), "]"), "utf-8"))
    )
    repos = records.select("part").distinct().select(
        part.cast("int").alias("repo_pos"),
        text("publisso-", part).alias("name"),
        listing_url.alias("url"),
        F.lit("publisso").alias("sitemap"),
        F.lit(None).cast("string").alias("metadata"),
        F.lit(False).alias("commit"),
    )
    return repos, listed


def split_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Catalog and responses: one repository per range of customers, listed by id.

    Of nine repositories, the last cannot be listed; every page with remainder 7 is not found.
    """
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows = rows.withColumn("part", block_range("c_custkey", CUSTOMERS_PER_LISTING))
    part, key = F.col("part"), F.col("c_custkey")
    listing_url = text("https://ids.example.org/", part)
    listings = joined(rows, "part", "c_custkey", text('{"id":"mods_', key, '"}'), ",")
    ids = F.when(part % 9 == 8, "[]").otherwise(
        text('{"response":{"docs":[', F.col("listing"), "]}}")
    )
    listed = listings.select(*_answer(listing_url, F.encode(ids, "utf-8")))
    page = text(
        '<html><script type="application/ld+json">',
        publisher_entry(key, F.col("c_name")),
        "</script></html>",
    )
    paged = rows.select(
        *_answer(
            text("https://www.openagrar.de/receive/mods_", key),
            F.encode(page, "utf-8"),
            F.when(key % CUSTOMERS_PER_LISTING == 7, 404).otherwise(200),
        )
    )
    repos = rows.select("part").distinct().select(
        part.cast("int").alias("repo_pos"),
        text("openagrar-", part).alias("name"),
        listing_url.alias("url"),
        F.lit("openagrar").alias("sitemap"),
        F.lit("embedded_jsonld").alias("metadata"),
        F.lit(True).alias("commit"),
    )
    return repos, listed.unionByName(paged)
