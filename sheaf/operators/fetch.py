"""What came of each request: outcome, text, and how far a failure reaches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.charsets import decoded_text, has_mark
from sheaf.functions.urls import request_key, url_scheme
from sheaf.sources.responses import latest_by_url

LISTING, DATASET = "listing", "dataset"


def status_outcome(status: Column, net_error: Column, client_error_scope: str = DATASET) -> Column:
    """``ok``, ``response`` or ``technical``.

    Server and network errors are technical. A client error concerns one dataset by default; with
    ``client_error_scope='repo'`` it counts as technical, as it does on a live session.
    """
    if client_error_scope not in (DATASET, "repo"):
        raise ValueError(f"client_error_scope must be 'dataset' or 'repo': {client_error_scope!r}")
    client_error = "response" if client_error_scope == DATASET else "technical"
    return (
        F.when(net_error.isNotNull() | status.isNull() | (status >= 500), "technical")
        .when(status >= 400, client_error)
        .otherwise("ok")
    )


def url_outcome(url: Column, landed: Column) -> Column:
    """Outcome of a request, given the outcome that landed for its URL (NULL if none did).

    An unsupported scheme is an argument error. A web URL that never landed was not reachable; a
    file that was not found is a response error.
    """
    scheme = url_scheme(url)
    return (
        F.when(~scheme.isin("http", "https", "file"), "argument")
        .when(landed.isNotNull(), landed)
        .when(scheme == "file", "response")
        .otherwise("technical")
    )


def error_scope(stage: str, outcome: Column) -> Column:
    """What an outcome takes down: nothing (NULL), ``dataset``, ``repo`` or ``run``."""
    if stage == LISTING:
        return (
            F.when(outcome == "ok", F.lit(None))
            .when(outcome.isin("unknown_key", "missing_key"), "run")
            .otherwise("repo")
        )
    return (
        F.when(outcome == "ok", F.lit(None))
        .when(outcome.isin("technical", "argument"), "repo")
        .when(outcome == "unknown_key", "run")
        .otherwise("dataset")
    )


def landed_outcomes(
    responses: DataFrame, client_error_scope: str = DATASET, unique_urls: bool = False
) -> DataFrame:
    """``(url, outcome)`` before decoding; the scan reads no bodies."""
    outcome = status_outcome(F.col("status"), F.col("net_error"), client_error_scope)
    df = responses.withColumns({"url": request_key(F.col("url")), "outcome": outcome})
    return df.select("url", "outcome") if unique_urls else latest_by_url(df, ["outcome"])


def landed_texts(
    responses: DataFrame, client_error_scope: str = DATASET, detect: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Replace ``body`` by ``outcome`` and ``content``. A narrow step: nothing is shuffled.

    ``detect`` (see :func:`sheaf.functions.detection.charset_detector`) reads the bodies that neither their own bytes
    nor a declared charset explain, and those in which zero bytes make UTF-8 unlikely.
    """
    charset = F.col("charset") if "charset" in responses.columns else None
    outcome = status_outcome(F.col("status"), F.col("net_error"), client_error_scope)
    df = responses.withColumns({"url": request_key(F.col("url")), "outcome": outcome})
    df = df.withColumn(
        "content", F.when(F.col("outcome") == "ok", decoded_text(F.col("body"), charset))
    )
    if detect is not None:
        zeros = F.col("content").contains("\x00") & ~has_mark(F.col("body"))
        unclear = (F.col("outcome") == "ok") & (F.length("body") > 0) & (F.col("content").isNull() | zeros)
        df = df.withColumn("_detected", detect(F.when(unclear, F.col("body"))))
        df = df.withColumn("content", F.coalesce("_detected", "content")).drop("_detected")
    undecoded = (F.col("outcome") == "ok") & F.col("content").isNull()
    return df.withColumn("outcome", F.when(undecoded, "decode").otherwise(F.col("outcome"))).drop(
        "body", "charset"
    )


def fetch(requests: DataFrame, landed: DataFrame) -> DataFrame:
    """One outcome per requested position; ``landed`` is unique by URL and has an ``outcome``.

    A URL that a large share of all rows asks for makes a large partition of the requests. AQE cuts it by its measured
    bytes and copies the one landed row, if ``landed`` was written and read back: it does not where that side is an
    aggregate by URL that the join takes over as it is partitioned.
    """
    requests = requests.withColumn("_key", request_key(F.col("url")))
    landed = landed.withColumnRenamed("url", "_key")
    df = requests.join(landed, "_key", "left").drop("_key")
    return df.withColumn("outcome", url_outcome(F.col("url"), F.col("outcome")))
