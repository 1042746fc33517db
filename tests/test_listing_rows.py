import json
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheaf.operators import listings as lists
from sheaf.operators.listings import Members, listing_rows, listings_of, member_entries, member_urls, parse_listings
from sheaf.operators.pull import json_ids, json_records, xml_texts
from tests.test_harvest import LISTINGS, NS, sitemap

SCHEMA = "name string, sitemap string, metadata string, content string"


def test_rows_agree_with_arrays(spark):
    rows = [(str(i), key, "jsonld", content) for i, (key, content, *_) in enumerate(LISTINGS)]
    rows += [("null", "xml", "jsonld", None), ("no extractor", "xml", None, sitemap("http://a"))]
    df = spark.createDataFrame(rows, SCHEMA)
    found = listing_rows(df).cache()
    whole = {r.name: r for r in parse_listings(df).collect()}
    heads = {r.name: r for r in listings_of(found).collect()}
    assert heads.keys() == whole.keys()
    members = {}
    for r in member_urls(found).orderBy("repo", "url_pos").collect():
        members.setdefault(r.repo, []).append(r.url)
    for r in member_entries(found).orderBy("repo", "item_pos").collect():
        members.setdefault(r.repo, []).append(r.entry)
    for name, want in whole.items():
        if name == "null":
            continue
        assert (heads[name]["mode"], heads[name].scope, heads[name].cause) == (want["mode"], want.scope, want.cause), want
        used = {"crawl": want.urls, "inline": want["items"]}.get(want["mode"]) or []
        assert members.get(name, []) == used and heads[name].n_members == len(used)


def test_errors_keep_their_order(spark):
    rows = [
        ("technical", "unheard-of", None, None),
        ("ok", "xml", "unheard-of", "broken"),
        ("ok", "xml", "unheard-of", sitemap("http://a")),
        ("ok", "publisso", "unheard-of", "[1]"),
        ("ok", "xml", None, sitemap("http://a")),
        ("ok", None, None, "[1]"),
    ]
    df = spark.createDataFrame(rows, "outcome string, sitemap string, metadata string, content string")
    df = df.withColumn("name", F.lit("r")).coalesce(1)
    found = listing_rows(df, extractor_keys=("jsonld",))
    assert [(r.scope, r["mode"]) for r in listings_of(found).collect()][:5] == [
        ("repo", "none"), ("repo", "none"), ("run", "none"), (None, "inline"), (None, "none"),
    ]
    assert member_urls(found).count() == 0 and member_entries(found).count() == 1


@pytest.mark.parametrize(
    "text",
    ['[1,2', "[1,]", "[1 2]", '{"a":[1],}', '{"a" [1]}', '{"a":[1]} x', '{"a":[1]', "{1:2}", "", " ", "[" * 100_000, '{"a":[1,{"b":}]}'],
)
def test_no_member_of_a_malformed_text(text):
    with pytest.raises(ValueError):
        next(json_records("a")(text))
    with pytest.raises(ValueError):
        next(json_records()(text))


def test_keys(spark):
    assert list(json_records("a", "b")('{"a": {"b": 1}, "c": [], "a": {"x": {}, "b": [ 2 , {"d": [3]} ]}}')) == ["2", '{"d": [3]}']
    for text in ('{"a": {"b": [1]}, "a": 5}', "[]", '{"b": 1}'):
        with pytest.raises(KeyError):
            next(json_records("a", "b")(text))
    assert list(json_ids("u/", "d")('{"d":[{"id":"x","id":1.0},{"id":{"b":2,"a":[]}}]}')) == ["u/1.0", 'u/{"a":[],"b":2}']


def test_elements_within_elements():
    read = xml_texts("{n}l")
    assert list(read('<r xmlns="n"><l>a<l>b<x><l/></x></l>tail</l><l>c</l><l><l>d</l></l></r>')) == ["a", "b", "c", "d"]
    assert list(read('<l xmlns="n">root<l> x\n</l></l>')) == [" x\n"]
    for text in ("<r>&what;</r>", "<r><l>", "", "<r/>junk", '<!DOCTYPE r SYSTEM "x"><r xmlns="n"><l>a</l>&what;</r>'):
        with pytest.raises(ValueError):
            list(read(text))


def test_own_reader(spark):
    df = spark.createDataFrame([("r", "lines", "jsonld", "http://a\nhttp://b")], SCHEMA)
    found = listing_rows(df, {"lines": Members(lambda text: iter(text.split("\n")))})
    assert [(r.url_pos, r.url) for r in member_urls(found).orderBy("url_pos").collect()] == [(0, "http://a"), (1, "http://b")]


def test_batches_are_bounded():
    sizes = [len(b) for b in lists._batches(["x"] * 10_000)]
    assert sizes == [4096, 4096, 1808]
    long = ["y" * 700_000] * 3
    assert [len(b) for b in lists._batches(long)] == [1, 1, 1]


def large_listings():
    records = "[" + ", ".join(json.dumps({"name": f"record {i}", "n": i, "license": ["a", "b"]}) for i in range(200_000)) + "]"
    urls = f'<urlset xmlns="{NS}">' + "".join(f"<url><loc>http://a/{i}</loc></url>" for i in range(200_000)) + "</urlset>"
    return records, urls


def test_a_large_listing_takes_no_tree():
    for read, text in zip((json_records(), xml_texts(lists._LOC)), large_listings(), strict=True):
        tracemalloc.start()
        members = iter(read(text))
        for _ in range(1000):
            next(members)
        assert tracemalloc.get_traced_memory()[1] < 2_000_000
        tracemalloc.stop()


def test_a_large_listing_is_quick(spark):
    records, urls = large_listings()
    df = spark.createDataFrame([("r", "publisso", None, records), ("u", "xml", "jsonld", urls)], SCHEMA).coalesce(1).cache()
    df.count()
    listing_rows(spark.createDataFrame([("r", "publisso", None, "[1]")], SCHEMA)).count()
    started = time.monotonic()
    found = listing_rows(df).groupBy("name", "mode").agg(F.count("member").alias("n"), F.max("position").alias("last")).collect()
    assert sorted((r.name, r.n, r.last) for r in found) == [("r", 200_000, 199_999), ("u", 200_000, 199_999)]
    print("seconds for both", time.monotonic() - started)
    assert time.monotonic() - started < 8


def test_long_listings_reach_python_in_small_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    listing_rows(spark.createDataFrame([("r", "publisso", None, "[1]")], SCHEMA)).count()

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["size"])

    texts = spark.range(2000).coalesce(1).select(F.repeat(F.col("id").cast("string"), 5000).alias("content"))
    found = [r.size for r in texts.mapInArrow(sizes, "size long").collect()]
    assert len(found) > 3 and max(found) < 6_000_000
