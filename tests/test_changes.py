from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.operators.changes import version_changes
from sheaf.operators.reports import report_levels
from sheaf.plans.harvest import harvest
from sheaf.schemas import LANDED_AT, RESPONSES
from sheaf.streaming.incremental import advance, extracted_responses, read_extracted, stream_responses

VERSION = "file_name string, name string, entry string"


def brute(old, new):
    net = defaultdict(Counter)
    for rows, sign in ((old, -1), (new, 1)):
        for file, name, entry in rows:
            net[file, name][entry] += sign
    found = {}
    for key, contents in net.items():
        more, less = sum(n for n in contents.values() if n > 0), -sum(n for n in contents.values() if n < 0)
        if more or less:
            found[key] = (more - min(more, less), less - min(more, less), min(more, less))
    return found


def test_changes_against_brute_force(spark):
    old = [("f", str(i % 40), f"text {i % 7}") for i in range(200)] + [("f", None, "x"), ("g", "a", None), ("g", "a", "")]
    new = [("f", str(i % 45), f"text {i % 5}") for i in range(230)] + [("f", None, "y"), ("g", "a", "")]
    new += [("hot", "one", f"copy {i % 3}") for i in range(500)]
    changes = version_changes(spark.createDataFrame(old, VERSION), spark.createDataFrame(new, VERSION), F.col("name"))
    got = {(r.file_name, r.identity): (r.added, r.removed, r.changed) for r in changes.collect()}
    assert got == brute(old, new) and got["f", None] == (0, 0, 1) and got["hot", "one"] == (500, 0, 0)
    same = spark.createDataFrame(old, VERSION)
    assert version_changes(same, same.repartition(3), F.col("name")).count() == 0
    assert version_changes(same.limit(0), same.limit(0), F.col("name")).count() == 0


def test_levels_tell_nulls_from_sums(spark):
    rows = [("generic", "ok", "r", "u"), ("generic", "ok", None, "u"), ("split", None, "s", None)]
    df = spark.createDataFrame(rows, "route string, outcome string, repo string, url string")
    got = {(r.level, r.route, r.outcome, r.repo): (r.n_urls, r.n_distinct) for r in report_levels(df).collect()}
    assert got[7, None, None, None] == (3, 1) and got[1, "generic", "ok", None] == (2, 1)
    assert got[0, "generic", "ok", None] == (1, 1) and got[3, "split", None, None] == (1, 0)
    assert got[5, None, None, None] == (1, 0) and len(got) == 10


def landed(spark, path, *rows):
    schema = T.StructType([*RESPONSES.fields, LANDED_AT])
    rows = [(url, status, body and bytearray(body.encode()), None, datetime(2024, 1, day)) for url, status, body, day in rows]
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def page(n):
    return f'<script type="application/ld+json">{{"n": {n}}}</script>'


def test_runs_go_on_where_the_last_one_ended(spark, tmp_path):
    path, root = str(tmp_path / "landed"), str(tmp_path / "run")

    def run():
        advance(extracted_responses(stream_responses(spark, path, files_per_batch=1)), root)
        return sorted((r.url, r.outcome, r.landed_at.day, r.by_embedded_jsonld.entries) for r in read_extracted(spark, root).collect())

    landed(spark, path, ("http://a", 200, page(1), 2), ("http://b", 503, None, 2))
    first = [("http://a", "ok", 2, ['{"n":1}']), ("http://b", "technical", 2, None)]
    assert run() == first
    assert run() == first  # nothing landed: no file is read again
    # An answer that is late, and older than the one before it, does not replace it.
    landed(spark, path, ("http://b", 200, page(2), 3), ("http://a", 404, None, 1))
    assert run() == sorted([*first, ("http://a", "response", 1, None), ("http://b", "ok", 3, ['{"n":2}'])], key=repr)

    ns = "http://www.sitemaps.org/schemas/sitemap/0.9"
    listing = f'<urlset xmlns="{ns}"><loc>http://a</loc><loc>http://b</loc></urlset>'
    lists = spark.createDataFrame([("http://s", 200, bytearray(listing.encode()), None)], "url string, status int, body binary, net_error string")
    repos = spark.createDataFrame(
        [(0, "r", "http://s", "xml", "embedded_jsonld", True)], "repo_pos int, name string, url string, sitemap string, metadata string, commit boolean"
    )
    pages = read_extracted(spark, root)
    done = harvest(repos, pages, listing_responses=lists, extracted=True)
    assert sorted(r.entry for r in done.entries.collect()) == ['{"n":1}', '{"n":2}']
    with pytest.raises(ValueError):
        harvest(repos, pages, extracted=True)
