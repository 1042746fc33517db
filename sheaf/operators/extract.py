"""Metadata extraction from dataset documents.

An extractor takes a frame with ``content`` and adds ``entries ARRAY<STRING>`` (canonical JSON, NULL
if the document could not be parsed) and ``raw ARRAY<STRING>`` (the unparsed blocks). Add your own
to a copy of ``EXTRACTORS``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.html import jsonld_blocks
from sheaf.functions.json import with_block_items, with_records

Extractor = Callable[[DataFrame], DataFrame]


def embedded_jsonld(df: DataFrame) -> DataFrame:
    """JSON-LD scripts of an HTML page. One bad or empty block fails the page; no block is no entry."""
    # The page itself is not needed behind this point, so keep it out of the rows that go on.
    return with_block_items(df.withColumn("raw", jsonld_blocks(F.col("content"))), "raw", "entries")


def jsonld(df: DataFrame) -> DataFrame:
    """A standalone JSON-LD document: its members if it is a list, else the document."""
    df = with_records(df, "content", "_document")
    return df.withColumns(
        {"entries": F.col("_document.items"), "raw": F.array("content")}
    ).drop("_document")


EXTRACTORS: dict[str, Extractor] = {"embedded_jsonld": embedded_jsonld, "jsonld": jsonld}


def extract_all(
    landed: DataFrame,
    extractors: Mapping[str, Extractor] = EXTRACTORS,
    wanted: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Run the extractors on landed documents, in one pass and without a shuffle.

    Which one a document needs is only known for sure once its URL meets a repository. Parsing first
    means that this meeting moves entries, not bodies, and that a URL listed many times is parsed
    once. ``wanted(key)`` tells of each document whether that extractor may be asked for (see
    :mod:`sheaf.operators.requested`); without it all of them see all documents.

    Replaces ``content`` by one struct column ``(entries, raw)`` per extractor.
    """
    others = [c for c in landed.columns if c != "content"]
    df = landed.withColumn("_content", F.col("content"))
    for key, extractor in extractors.items():
        df = df.withColumn("content", F.col("_content") if wanted is None else F.when(wanted(key), F.col("_content")))
        df = extractor(df)
        failed = F.col("content").isNotNull() & F.col("entries").isNull()
        result = F.struct("entries", F.when(failed, F.col("raw")).alias("raw"))
        df = df.withColumn(f"by_{key}", result).drop("entries", "raw")
    return df.select(*others, *(f"by_{key}" for key in extractors))


def choose_extractor(df: DataFrame, extractors: Mapping[str, Extractor] = EXTRACTORS) -> DataFrame:
    """Keep the result of the extractor that ``metadata`` names, as ``entries`` and ``raw``.

    An unknown key turns a document that was fetched into the outcome ``unknown_key``.
    """
    known = F.col("metadata").isin(*extractors)

    def chosen(field: str) -> Column:
        return F.coalesce(
            *(F.when(F.col("metadata") == key, F.col(f"by_{key}.{field}")) for key in extractors)
        )

    df = df.withColumns({"entries": chosen("entries"), "raw": chosen("raw")})
    outcome = (
        F.when(F.col("outcome") != "ok", F.col("outcome"))
        .when(~F.coalesce(known, F.lit(False)), "unknown_key")
        .when(F.col("entries").isNull(), "parse")
        .otherwise("ok")
    )
    return df.withColumn("outcome", outcome).drop(*(f"by_{key}" for key in extractors))


def extract_by_key(
    pages: DataFrame, extractors: Mapping[str, Extractor] = EXTRACTORS
) -> DataFrame:
    """Extract from documents whose ``metadata`` key is already known.

    Like :func:`extract_all` followed by :func:`choose_extractor`, but each extractor only sees the
    documents that ask for it.
    """
    df = pages if "outcome" in pages.columns else pages.withColumn("outcome", F.lit("ok"))
    df = df.withColumn("_content", F.col("content"))
    for key, extractor in extractors.items():
        mine = F.col("metadata") == key
        df = extractor(df.withColumn("content", F.when(mine, F.col("_content"))))
        failed = F.col("content").isNotNull() & F.col("entries").isNull()
        result = F.struct("entries", F.when(failed, F.col("raw")).alias("raw"))
        df = df.withColumn(f"by_{key}", result).drop("entries", "raw")
    return choose_extractor(df.drop("content", "_content"), extractors)


def flatten_entries(pages: DataFrame) -> DataFrame:
    """Entries of the documents that gave a list, with their position: URL first, then item."""
    listed = pages.where(F.col("entries").isNotNull())
    return listed.select("repo", "url_pos", F.posexplode("entries").alias("item_pos", "entry"))


def dead_letters(pages: DataFrame) -> DataFrame:
    """Documents that gave no list, with the data that was suspicious if it was the parse."""
    failed = pages.where(F.col("outcome") != "ok")
    return failed.select(
        "repo",
        "url_pos",
        "url",
        "outcome",
        F.lit("dataset").alias("scope"),
        F.array_join("raw", "").alias("suspicious_data"),
    )


def lost_letters(lost: DataFrame) -> DataFrame:
    """The URLs that dropped their repository, each as a letter without position."""
    return _letters(lost, F.lit("repo"))


def listing_letters(listings: DataFrame) -> DataFrame:
    """Listings that could not be fetched or read: the cause why their repository was skipped."""
    failed = listings.where(F.col("scope").isNotNull())
    return _letters(failed.withColumn("repo", F.col("name")).withColumn("outcome", F.col("cause")), F.concat(F.lit("listing: "), "scope"))


def _letters(rows: DataFrame, scope: Column) -> DataFrame:
    nothing = F.lit(None)
    return rows.select(
        "repo", nothing.cast("int").alias("url_pos"), "url", "outcome", scope.alias("scope"), nothing.cast("string").alias("suspicious_data")
    )
