"""The whole harvest: catalog and landed responses in, documents, reports and snapshots out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.urls import request_key
from sheaf.operators.extract import (
    EXTRACTORS,
    Extractor,
    choose_extractor,
    dead_letters,
    extract_all,
    flatten_entries,
    listing_letters,
    lost_letters,
)
from sheaf.operators.fetch import DATASET, fetch, landed_outcomes, landed_texts, url_outcome
from sheaf.operators.listings import (
    READERS,
    Members,
    listing_rows,
    listings_of,
    member_entries,
    member_urls,
)
from sheaf.operators.reports import crawl_counts, harvest_reports, lost_urls, run_report
from sheaf.operators.requested import asked, asked_for, request_bitmap
from sheaf.operators.reshape import reshape
from sheaf.operators.routing import (
    RESHAPE_TARGET,
    SPLIT_TARGETS,
    bad_publishers,
    publish_flag,
    route_of,
    split_by_publisher,
    split_reports,
)
from sheaf.plans.staging import unstaged
from sheaf.sources.files import file_responses
from sheaf.sources.responses import latest_by_url

POSITIONS = ("url_pos", "item_pos", "title_pos", "description_pos", "license_pos")


@dataclass(frozen=True)
class Harvest:
    """Tables of one run; all lazy but for what was staged on the way."""

    listings: DataFrame  # one row per repository, with what came of its listing
    pages: DataFrame  # one row per followed URL, with its entries
    entries: DataFrame  # repo, url_pos, item_pos, entry
    reports: DataFrame  # per repository, before routing
    dead_letters: DataFrame  # URLs that gave nothing because of an error, and how far it reached
    run_errors: DataFrame  # errors that forbid publishing


def fetch_listings(
    repos: DataFrame,
    responses: DataFrame,
    client_error_scope: str = DATASET,
    detect: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``outcome`` and ``content`` of each repository's listing.

    Responses are first reduced to the listings by a semi-join with the catalog, which is broadcast where the
    optimiser knows or measures it to be small. Listings that are landed apart are best handed over apart.
    """
    repos = repos.withColumn("_key", request_key(F.col("url")))
    wanted = repos.select(F.col("_key").alias("url")).distinct()
    hits = responses.withColumn("url", request_key(F.col("url"))).join(wanted, "url", "left_semi")
    hits = latest_by_url(landed_texts(hits, client_error_scope, detect), ["outcome", "content"])
    joined = repos.join(hits.withColumnRenamed("url", "_key"), "_key", "left").drop("_key")
    return joined.withColumn("outcome", url_outcome(F.col("url"), F.col("outcome")))


def crawl(
    urls: DataFrame,
    responses: DataFrame,
    *,
    client_error_scope: str = DATASET,
    extractors: Mapping[str, Extractor] = EXTRACTORS,
    stage: Callable[[DataFrame, str], DataFrame],
    unique_urls: bool = False,
    detect: Callable[[Column], Column] | None = None,
    extracted: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Follow ``urls (repo, metadata, url_pos, url)``: the pages, the repositories dropped, and the URLs that did it.

    Which repositories drop out is settled on statuses alone, before any body is read. Then a bitmap of the URLs still
    followed is held against each landed row, so that only bodies which are asked for are decoded, and each extractor
    parses only those that ask for it. What landed is staged before it meets the requests, so that AQE can split a
    URL that very many of them name. ``extracted`` says that the bodies were decoded and parsed before.
    """
    requests = urls.select("repo", "url").distinct()
    statuses = landed_outcomes(responses, client_error_scope, unique_urls)
    statuses = statuses if unique_urls else stage(statuses, "statuses")
    lost = stage(lost_urls(fetch(requests, statuses)), "lost")
    aborted = lost.select("repo").distinct()
    followed = urls.join(aborted, "repo", "left_anti")
    results = [f"by_{key}" for key in extractors]
    wanted = asked_for(responses, request_bitmap(followed, extractors))
    landed = wanted if extracted else extract_all(landed_texts(wanted, client_error_scope, detect), extractors, asked)
    if not unique_urls:
        landed = stage(latest_by_url(landed, ["outcome", *results]), "landed")
    landed = landed.select("url", "outcome", *results)
    pages = choose_extractor(fetch(followed, landed), extractors)
    pages = pages.select("repo", "url_pos", "url", "outcome", "entries", "raw")
    return stage(pages, "pages"), aborted, lost


def harvest(
    repos: DataFrame,
    responses: DataFrame,
    files: DataFrame | None = None,
    *,
    base_dir: str = "",
    client_error_scope: str = DATASET,
    readers: Mapping[str, Members] = READERS,
    extractors: Mapping[str, Extractor] = EXTRACTORS,
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
    unique_urls: bool = False,
    listing_responses: DataFrame | None = None,
    detect: Callable[[Column], Column] | None = None,
    extracted: bool = False,
) -> Harvest:
    """Harvest every repository of the catalog in one plan.

    ``files`` (see :func:`sheaf.sources.files.scan_files`) answers ``file:`` URLs. Set
    ``unique_urls`` if the responses hold every URL once: the entries are then not reduced by URL
    before they meet the requests, which saves sorting all of them. ``listing_responses`` answers the
    listings if they are landed apart: no body of a page is then read to find them. ``stage`` (see
    :class:`sheaf.plans.staging.Stage`) writes what several results read; without it all is one lazy plan. ``detect``
    reads bodies whose charset nothing declares (see :mod:`sheaf.functions.detection`). ``extracted`` says that
    ``responses`` is what an incremental harvest has made of them (see :mod:`sheaf.streaming.incremental`, with the same
    ``client_error_scope`` and ``extractors``); listings are then landed apart, and there are no ``files``.
    """
    if extracted and (listing_responses is None or files is not None):
        raise ValueError("extracted responses go with listing_responses and without files")

    def answered(requests: DataFrame, landed: DataFrame) -> DataFrame:
        if files is None:
            return landed
        local = file_responses(requests, files, base_dir)
        return landed.unionByName(local, allowMissingColumns=True)

    lists = responses if listing_responses is None else listing_responses
    fetched = fetch_listings(repos, answered(repos, lists), client_error_scope, detect)
    rows = stage(listing_rows(fetched, readers, tuple(extractors)), "listings")
    listings, urls = listings_of(rows), member_urls(rows)
    pages, aborted, lost = crawl(
        urls,
        answered(urls, responses),
        client_error_scope=client_error_scope,
        extractors=extractors,
        stage=stage,
        unique_urls=unique_urls,
        detect=detect,
        extracted=extracted,
    )
    entries = flatten_entries(pages).unionByName(member_entries(rows))
    reports = harvest_reports(listings, aborted, crawl_counts(pages))
    to_split = entries.where(route_of(F.col("repo")) == "split")
    run_errors = listings.where(F.col("scope") == "run").select(
        F.col("name").alias("repo"), F.lit("unknown or missing key").alias("problem")
    )
    run_errors = run_errors.unionByName(
        bad_publishers(to_split).select("repo", F.lit("publisher of a wrong type").alias("problem"))
    )
    letters = dead_letters(pages).unionByName(lost_letters(lost)).unionByName(listing_letters(listings))
    return Harvest(listings, pages, entries, reports, letters, run_errors)


def route_outputs(
    entries: DataFrame,
    on_error: str = "truncate",
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
) -> DataFrame:
    """All files of a run as rows ``(repo, file_name, position, entry)``.

    Every repository with entries has a file of its own name; the special routes add theirs, and
    replace it where the names are equal.
    """
    route = route_of(F.col("repo"))
    own = entries.withColumn("file_name", F.concat("repo", F.lit(".json")))
    special = F.when(route == "reshape", F.array(F.lit(RESHAPE_TARGET))).when(
        route == "split", F.array(*(F.lit(target) for target in SPLIT_TARGETS))
    )
    own = own.where(~F.coalesce(F.array_contains(special, F.col("repo")), F.lit(False)))
    split = split_by_publisher(entries.where(route == "split"))
    split = split.withColumn("file_name", F.concat("target", F.lit(".json"))).drop("target")
    reshaped = reshape(entries.where(route == "reshape"), on_error, stage).withColumn(
        "file_name", F.lit(f"{RESHAPE_TARGET}.json")
    )
    whole = own.unionByName(split).unionByName(reshaped, allowMissingColumns=True)
    positions = [F.coalesce(F.col(p), F.lit(0)).alias(p) for p in POSITIONS]
    return whole.select("repo", "file_name", *positions, "entry")


def final_report(reports: DataFrame, entries: DataFrame) -> DataFrame:
    """The run report after routing.

    A reshape keeps the harvest's counts under its file's name; a split replaces them by its own two
    reports, which have no failures. Repositories without entries keep their report.
    """
    route = F.when(F.col("valid_entries") > 0, route_of(F.col("repo_name"))).otherwise("generic")
    routed = reports.withColumn("route", route)
    kept = routed.where(F.col("route") != "split").withColumn(
        "repo_name",
        F.when(F.col("route") == "reshape", RESHAPE_TARGET).otherwise(F.col("repo_name")),
    )
    split_repos = routed.where(F.col("route") == "split").select(
        "repo_pos", F.col("repo_name").alias("repo")
    )
    split = split_by_publisher(entries.where(route_of(F.col("repo")) == "split"))
    return run_report(kept, split_reports(split, split_repos))


def output_files(reports: DataFrame, repos: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row per file ``(repo_pos, repo, url, file_name, published, row_count)``.

    Repositories without entries have no file; a special route's file exists even if it is empty.
    """
    route = route_of(F.col("name"))
    special = F.when(route == "reshape", F.array(F.lit(RESHAPE_TARGET))).when(
        route == "split", F.array(*(F.lit(target) for target in SPLIT_TARGETS))
    ).otherwise(F.array().cast("array<string>"))
    names = F.array_distinct(F.concat(F.array("name"), special))
    filled = reports.where("valid_entries > 0").select(F.col("repo_name").alias("name"))
    files = repos.join(filled, "name", "left_semi").select(
        "repo_pos",
        F.col("name").alias("repo"),
        "url",
        F.explode(names).alias("file"),
        special.alias("special"),
        publish_flag(F.col("name"), F.col("commit")).alias("flag"),
    )
    own = (F.size("special") == 0) | F.array_contains("special", F.col("file"))
    counts = outputs.groupBy("repo", "file_name").agg(F.count(F.lit(1)).alias("row_count"))
    return (
        files.withColumn("file_name", F.concat("file", F.lit(".json")))
        .withColumn("published", F.col("flag") & own)
        .join(counts, ["repo", "file_name"], "left")
        .select(
            "repo_pos", "repo", "url", "file_name", "published",
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        )
    )
