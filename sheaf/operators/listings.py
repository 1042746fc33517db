"""Listings ("sitemaps") of repositories: dataset URLs to follow, or the records themselves.

``listing_rows`` gives a listing's members as rows: a reader goes through the text and hands them over in small batches,
so a listing of any number of members is no array. Add your own to a copy of ``READERS``.

A parser, as in ``PARSERS``, takes a frame whose ``content`` is NULL wherever the row is not its own, and adds
``urls ARRAY<STRING>``, ``items ARRAY<STRING>`` and ``problem STRING``. All parsers run over the same
rows in one pass; ``content`` may be fed to any pandas or Arrow UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.batches import bound_batches
from sheaf.functions.json import with_canonical, with_records
from sheaf.operators.fetch import LISTING, error_scope
from sheaf.operators.pull import Reader, json_ids, json_records, xml_texts

# Where dataset pages of the id-list repository live, and the sitemap namespace.
ID_LIST_BASE = "https://www.openagrar.de/receive/"
_LOC = "{http://www.sitemaps.org/schemas/sitemap/0.9}loc"

Parser = Callable[[DataFrame], DataFrame]

_XML = T.StructType().add("urls", T.ArrayType(T.StringType()))
_XML_ARROW = pa.struct([("urls", pa.list_(pa.string()))])


def _locations(text: str) -> dict:
    try:
        root = ElementTree.fromstring(text)
    except (ElementTree.ParseError, ValueError):
        return {"urls": None}
    return {"urls": [loc.text for loc in root.findall(f".//{_LOC}") if loc.text is not None]}


@F.arrow_udf(_XML)
def _xml_locations(contents: pa.Array) -> pa.Array:
    if contents.null_count == len(contents):
        return pa.nulls(len(contents), _XML_ARROW)
    rows = [None if text is None else _locations(text) for text in contents.to_pylist()]
    return pa.array(rows, _XML_ARROW)


def _nothing():
    return F.lit(None).cast("array<string>")


def xml_sitemap(df: DataFrame) -> DataFrame:
    """Every ``loc`` of the sitemap namespace at any depth, verbatim and in document order."""
    df = df.withColumn("_xml", _xml_locations.asNondeterministic()(F.col("content")))
    bad = F.col("content").isNotNull() & F.col("_xml.urls").isNull()
    return (
        df.withColumn("urls", F.col("_xml.urls"))
        .withColumn("items", _nothing())
        .withColumn("problem", F.when(bad, "malformed"))
        .drop("_xml")
    )


def id_list(base_url: str = ID_LIST_BASE) -> Parser:
    """Ids under ``response.docs``, each turned into a URL; one bad record spoils the listing.

    Any empty list, object or text there lists nothing; another object or text is walked by its keys or characters,
    which hold no ids.
    """

    def parse(df: DataFrame) -> DataFrame:
        df = with_records(df, "content", "_docs", ("response", "docs"))
        # An id is read from its record's canonical text: text form of any JSON value.
        df = df.withColumn(
            "_ids",
            F.transform(
                "_docs.items",
                lambda doc: F.try_variant_get(F.try_parse_json(doc), "$.id", "variant"),
            ),
        )
        ok = F.col("_docs.state") == "ok"
        nothing = ok & ~F.col("_docs.is_list") & F.get("_docs.items", F.lit(0)).isin("{}", '""')
        whole = nothing | (ok & F.col("_docs.is_list") & F.forall("_ids", lambda value: value.isNotNull()))
        urls = F.transform("_ids", lambda value: F.concat(F.lit(base_url), _python_text(value)))
        urls = F.when(nothing, F.array().cast("array<string>")).otherwise(urls)
        bad = F.col("content").isNotNull() & ~F.coalesce(whole, F.lit(False))
        return (
            df.withColumn("urls", F.when(whole, urls))
            .withColumn("items", _nothing())
            .withColumn("problem", F.when(bad, "malformed"))
            .drop("_docs", "_ids")
        )

    return parse


def _python_text(value):
    """Text form of a JSON scalar inside a URL."""
    text = F.to_json(value)
    return (
        F.when(text.startswith('"'), F.try_variant_get(value, "$", "string"))
        .when(text == "null", "None")
        .when(text.isin("true", "false"), F.initcap(text))
        .otherwise(text)
    )


def inline_records(*keys: str) -> Parser:
    """The listing is the metadata itself: the whole document, or what it holds under ``keys``."""

    def parse(df: DataFrame) -> DataFrame:
        df = with_records(df, "content", "_records", keys)
        state = F.col("_records.state")
        problem = F.when(state == "parse", "malformed").when(state == "missing", "missing_key")
        return (
            df.withColumn("urls", _nothing())
            .withColumn("items", F.col("_records.items"))
            .withColumn("problem", problem)
            .drop("_records")
        )

    return parse


PARSERS: dict[str, Parser] = {
    "openagrar": id_list(),
    "publisso": inline_records(),
    "thunen_atlas": inline_records("resources"),
    "xml": xml_sitemap,
}


def parse_listings(
    listings: DataFrame,
    parsers: Mapping[str, Parser] = PARSERS,
    extractor_keys: tuple[str, ...] | None = None,
) -> DataFrame:
    """Parse each row's ``content`` with the parser its ``sitemap`` key names.

    Adds ``urls``, ``items``, ``mode`` (``inline``, ``crawl``, or ``none`` where nothing can be
    followed), ``scope`` (``repo``, ``run`` or NULL) and its ``cause``, and drops ``content``. If the frame has an
    ``outcome``, rows that were not fetched keep that error.
    """
    bound_batches(listings.sparkSession)
    outcome = F.col("outcome") if "outcome" in listings.columns else F.lit("ok")
    df = listings.withColumn("_outcome", outcome).withColumn("_content", F.col("content"))
    fetched = F.col("_outcome") == "ok"
    for number, (key, parse) in enumerate(parsers.items()):
        mine = fetched & (F.col("sitemap") == key)
        df = parse(df.withColumn("content", F.when(mine, F.col("_content"))))
        for column in ("urls", "items", "problem"):
            df = df.withColumnRenamed(column, f"_{column}{number}")

    def merged(column: str):
        return F.coalesce(*(F.col(f"_{column}{n}") for n in range(len(parsers))))

    df = df.withColumns({c: merged(c) for c in ("urls", "items", "problem")})
    known = F.col("sitemap").isin(*parsers)
    df = _judged(df, fetched, known, F.col("urls").isNotNull(), F.col("items").isNotNull(), extractor_keys)
    kept = [c for c in listings.columns if c != "content"]
    return df.select(*kept, "urls", "items", "mode", "scope", "cause")


def _has_extractor() -> Column:
    return F.col("metadata").isNotNull() & (F.col("metadata") != "")


def _extractor_known(extractor_keys: tuple[str, ...] | None) -> Column:
    return F.lit(True) if extractor_keys is None else F.col("metadata").isin(*extractor_keys)


def _judged(
    df: DataFrame, fetched: Column, known: Column, urls: Column, items: Column, extractor_keys: tuple[str, ...] | None
) -> DataFrame:
    """Add ``cause``, ``scope`` and ``mode`` of listings that gave ``urls`` or ``items`` or have a ``problem``."""
    result = (
        F.when(~fetched, F.col("_outcome"))
        .when(~known, "unknown_key")
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(urls & _has_extractor() & ~_extractor_known(extractor_keys), "unknown_key")
        .otherwise("ok")
    )
    df = df.withColumn("cause", result).withColumn("scope", error_scope(LISTING, F.col("cause")))
    good = F.col("scope").isNull()
    mode = F.when(good & items, "inline").when(good & urls & _has_extractor(), "crawl").otherwise("none")
    return df.withColumn("mode", mode)


def dataset_urls(parsed: DataFrame) -> DataFrame:
    """URLs to follow, in listing order, duplicates kept."""
    crawled = parsed.where(F.col("mode") == "crawl")
    return crawled.select(
        F.col("name").alias("repo"), "metadata", F.posexplode("urls").alias("url_pos", "url")
    )


def inline_entries(parsed: DataFrame) -> DataFrame:
    """Records that came with the listing, in listing order."""
    inline = parsed.where(F.col("mode") == "inline")
    return inline.select(
        F.col("name").alias("repo"),
        F.lit(0).alias("url_pos"),
        F.posexplode("items").alias("item_pos", "entry"),
    )


@dataclass(frozen=True)
class Members:
    """How a kind of listing is read: ``inline`` members are records, others are URLs."""

    read: Reader
    inline: bool = False


READERS: dict[str, Members] = {
    "openagrar": Members(json_ids(ID_LIST_BASE, "response", "docs")),
    "publisso": Members(json_records(), inline=True),
    "thunen_atlas": Members(json_records("resources"), inline=True),
    "xml": Members(xml_texts(_LOC)),
}

#: Members and characters that a batch of members holds at most (one member may be longer).
BATCH_MEMBERS, BATCH_CHARS = 4096, 1 << 20


def _batches(members: Iterable[str]) -> Iterator[list[str]]:
    batch, size = [], 0
    for member in members:
        if batch and (len(batch) == BATCH_MEMBERS or size + len(member) > BATCH_CHARS):
            yield batch
            batch, size = [], 0
        batch.append(member)
        size += len(member)
    if batch:
        yield batch


def listing_rows(
    listings: DataFrame, readers: Mapping[str, Members] = READERS, extractor_keys: tuple[str, ...] | None = None
) -> DataFrame:
    """Each listing as a row without ``position``, and before it a row for each of its members that is to be used.

    A listing's row has its columns (no ``content``), ``n_members``, ``mode``, ``scope`` and ``cause`` as
    :func:`parse_listings` gives them. A member's row has ``name``, ``metadata``, ``mode``, ``position`` from 0, and
    ``member``: a URL or the canonical text of a record. Members of a listing that is malformed, lacks its key, or whose
    URLs no extractor would read give no rows. One pass, no shuffle; meant to be staged, as both kinds are read after it.
    """
    bound_batches(listings.sparkSession)
    outcome = F.col("outcome") if "outcome" in listings.columns else F.lit("ok")
    kept = [c for c in listings.columns if c != "content"]
    inline = [key for key, members in readers.items() if members.inline]
    is_inline = F.col("sitemap").isin(*inline)
    # Content that is null was not fetched, or has no reader: it is settled by the rest of its row.
    mine = (outcome == "ok") & F.col("sitemap").isin(*readers)
    wanted = is_inline | (_has_extractor() & _extractor_known(extractor_keys))
    df = listings.select(*kept, F.when(mine, F.col("content")).alias("_text"), F.coalesce(wanted, F.lit(False)).alias("_wanted"))
    own = T.StructType([T.StructField(f.name, f.dataType) for f in listings.schema if f.name != "content"])
    added = T.StructType().add("position", "long").add("member", "string").add("n_members", "long").add("problem", "string")
    used = ("name", "sitemap", "metadata")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, problems = [], []
            for at in range(batch.num_rows):
                text, wanted = batch["_text"][at].as_py(), batch["_wanted"][at].as_py()
                count, problem = 0, None
                if text is not None:
                    try:
                        members = readers[batch["sitemap"][at].as_py()].read(text)
                        for found in _batches(members):
                            if not wanted:
                                break
                            repeated = {c: batch[c].slice(at, 1).take(pa.array([0] * len(found))) for c in used}
                            columns = [repeated[c] if c in used else pa.nulls(len(found), batch[c].type) for c in kept]
                            positions = pa.array(range(count, count + len(found)), pa.int64())
                            rest = [positions, pa.array(found, pa.string()), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.string())]
                            yield pa.record_batch(columns + rest, names=[*kept, *added.names])
                            count += len(found)
                    except ValueError:
                        problem = "malformed"
                    except KeyError:
                        problem = "missing_key"
                counts.append(count)
                problems.append(problem)
            n = batch.num_rows
            rest = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.array(counts, pa.int64()), pa.array(problems, pa.string())]
            yield pa.record_batch([batch[c] for c in kept] + rest, names=[*kept, *added.names])

    rows = df.mapInArrow(read, T.StructType([*own.fields, *added.fields]))
    member = F.col("position").isNotNull()
    rows = rows.withColumn("_record", F.when(member & is_inline, F.col("member")))
    rows = with_canonical(rows, "_record", "_record")
    rows = rows.withColumn("member", F.coalesce("_record", "member"))
    # A member's row has no outcome of its own; it is there because its listing was good.
    rows = rows.withColumn("_outcome", F.when(member, F.lit("ok")).otherwise(outcome))
    fetched, known = F.col("_outcome") == "ok", F.col("sitemap").isin(*readers)
    rows = _judged(rows, fetched, known, known & ~is_inline, known & is_inline, extractor_keys)
    return rows.select(*kept, "position", "member", "n_members", "mode", "scope", "cause")


def listings_of(rows: DataFrame) -> DataFrame:
    """The listings among ``listing_rows``, one row each."""
    return rows.where("position IS NULL").drop("position", "member")


def member_urls(rows: DataFrame) -> DataFrame:
    """URLs to follow, in listing order, duplicates kept."""
    crawled = rows.where("position IS NOT NULL AND mode = 'crawl'")
    return crawled.select(F.col("name").alias("repo"), "metadata", F.col("position").cast("int").alias("url_pos"), F.col("member").alias("url"))


def member_entries(rows: DataFrame) -> DataFrame:
    """Records that came with the listing, in listing order."""
    inline = rows.where("position IS NOT NULL AND mode = 'inline'")
    return inline.select(F.col("name").alias("repo"), F.lit(0).alias("url_pos"), F.col("position").cast("int").alias("item_pos"), F.col("member").alias("entry"))
