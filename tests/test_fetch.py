import pytest
from pyspark.sql import functions as F

from sheaf.functions.charsets import decoded_text
from sheaf.functions.urls import file_path, url_scheme
from sheaf.operators.fetch import (
    DATASET,
    LISTING,
    error_scope,
    fetch,
    landed_outcomes,
    landed_texts,
)
from sheaf.schemas import RESPONSES
from sheaf.sources.catalog import catalog_table, repo_catalog
from sheaf.sources.files import file_responses, scan_files
from sheaf.sources.responses import latest_by_url, read_responses


def column(spark, values, build, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    rows = df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


def test_schemes(spark):
    urls = {
        "http://a": "http", "HTTPS://a": "https", "\n  ht\ttp://a": "http", "file://./a": "file",
        "mailto:x": "mailto", "ftp://a": "ftp", "a/b": "", "1a:b": "", "": "", "a+b-c.d:x": "a+b-c.d",
    }
    assert column(spark, urls, url_scheme) == list(urls.values())


def test_file_paths(spark):
    urls = {
        "file://./dir/a.xml": "dir/a.xml", "file:///x": "x", "file://host/x": "/x", "file://test": "test",
        " \nfile://./a b/\nc?q#f": "a b/c", "file:a/b": "a/b", "FILE://./a//b/./c/": "a/b/c",
        "file://.//\\a": "a", "http://x/y": None, "file://h//x/": "/x",
    }
    assert column(spark, urls, file_path) == list(urls.values())


def test_decoding(spark):
    text = "Thünen – 😀"
    cases = [
        (text.encode(), None, text),
        (b"\xef\xbb\xbf" + text.encode(), None, text),
        (text.encode("utf-16"), None, text),
        (b"\xfe\xff" + text.encode("utf-16-be"), None, text),
        (text.encode("utf-32"), None, text),
        (b"\x00\x00\xfe\xff" + text.encode("utf-32-be"), None, text),
        (b"\xff\xfe\x00\xd8a\x00", None, None),
        (b"\xff\xfe\x00\xdc", None, None),
        (b"\xfe\xff\xd8\x00\x00a", None, None),
        (b"\xff\xfea", None, None),
        (b"\xff\xfe\x00\x00\x00\xd8\x00\x00", None, None),
        (b"\xff\xfe\x00\x00\x00\x00\x11\x00", None, None),
        (b"\xff\xff", "utf-8", None),
        (b"", None, None),
        (b"caf\xe9", None, None),
        (b"caf\xe9", "ISO-8859-1", "café"),
        (b"\x80 5", "windows-1252", "€ 5"),
        (b"\x81", "windows-1252", None),
        (b"\xa4\xe9", "iso-8859-15", "€é"),
        (b"caf\xe9", "koi8-r", None),
        (text.encode(), "iso-8859-1", text),
    ]
    rows = [(i, bytearray(body), charset) for i, (body, charset, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, body binary, charset string")
    got = df.select("i", decoded_text(F.col("body"), F.col("charset")).alias("t")).orderBy("i").collect()
    assert [row.t for row in got] == [want for _, _, want in cases]


def responses(spark):
    rows = [
        ("http://a/ok", 200, bytearray("tést".encode()), None),
        ("http://a/gone", 404, bytearray(b"no"), None),
        ("http://a/down", 502, None, None),
        ("http://a/net", None, None, "timeout"),
        ("http://a/bytes", 200, bytearray(b"\xff\xff"), None),
        ("http://a/empty", 200, bytearray(b""), None),
        ("ftp://a/x", 200, bytearray(b"x"), None),
        ("http://a/moved", 302, bytearray(b"x"), None),
    ]
    return spark.createDataFrame(rows, RESPONSES)


@pytest.mark.parametrize("scope, gone", [("dataset", "response"), ("repo", "technical")])
def test_outcomes(spark, scope, gone):
    requests = spark.createDataFrame(
        [(i, u) for i, u in enumerate(
            ["http://a/ok", "http://a/gone", "http://a/down", "http://a/net", "http://a/bytes",
             "http://a/empty", "ftp://a/x", "http://a/never", "file://./never", "http://a/moved", "http://a/ok"]
        )], "url_pos int, url string",
    )
    landed = latest_by_url(landed_texts(responses(spark), scope), ["outcome", "content"])
    rows = fetch(requests, landed).orderBy("url_pos").collect()
    assert [row.outcome for row in rows] == [
        "ok", gone, "technical", "technical", "decode", "decode", "argument", "technical", "response",
        "ok", "ok",
    ]
    assert rows[0].content == rows[10].content == "tést"
    slim = fetch(requests, landed_outcomes(responses(spark), scope))
    assert {r.outcome for r in slim.collect()} == {"ok", "technical", "argument", "response"}


def test_slim_outcomes_read_no_bodies(spark, tmp_path):
    responses(spark).write.parquet(str(tmp_path / "r"))
    scan = landed_outcomes(read_responses(spark, str(tmp_path / "r")))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string,status:int,net_error:string>" in plan


def test_scopes(spark):
    outcomes = ["ok", "response", "decode", "technical", "argument", "parse", "unknown_key", "missing_key", "malformed"]
    dataset = column(spark, outcomes, lambda c: error_scope(DATASET, c))
    assert dataset == [None, "dataset", "dataset", "repo", "repo", "dataset", "run", "dataset", "dataset"]
    listing = column(spark, outcomes, lambda c: error_scope(LISTING, c))
    assert listing == [None, "repo", "repo", "repo", "repo", "repo", "run", "run", "repo"]


def test_last_landed_copy_wins(spark):
    rows = [("u", 200, "a", "2024-01-01"), ("u", 404, "b", "2024-01-02"), ("v", 200, "c", "2024-01-01")]
    df = spark.createDataFrame(rows, "url string, status int, content string, at string")
    df = df.withColumn("landed_at", F.col("at").cast("timestamp"))
    got = {r.url: r.content for r in latest_by_url(df, ["content"]).collect()}
    assert got == {"u": "b", "v": "c"}


def test_catalog(spark):
    repos = repo_catalog(
        spark,
        [{"name": "a", "url": "u", "sitemap": "xml"},
         {"name": "b", "url": "v", "sitemap": "xml", "metadata": "jsonld", "commit": False, "http_client": {}}],
    )
    assert [tuple(r) for r in repos.orderBy("repo_pos").collect()] == [
        (0, "a", "u", "xml", None, True), (1, "b", "v", "xml", "jsonld", False)
    ]
    with pytest.raises(TypeError):
        repo_catalog(spark, [{"name": "a", "url": "u"}])
    with pytest.raises(TypeError):
        repo_catalog(spark, [{"name": "a", "url": "u", "sitemap": "xml", "extra": 1}])
    with pytest.raises(TypeError):
        catalog_table(repos.withColumn("extra", F.lit(1)))
    bare = catalog_table(repos.drop("metadata", "commit"))
    assert [(r.metadata, r.commit) for r in bare.collect()] == [(None, True)] * 2


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_bytes("ä".encode())
    requests = spark.createDataFrame(
        [(0, "file://./in/a.html"), (1, f"file://localhost{tmp_path}/in/a.html"), (2, "file://./in/b.html")],
        "url_pos int, url string",
    )
    files = scan_files(spark, str(tmp_path))
    landed = landed_texts(file_responses(requests, files, str(tmp_path)))
    rows = fetch(requests, landed).orderBy("url_pos").collect()
    assert [(r.outcome, r.content) for r in rows] == [("ok", "ä"), ("ok", "ä"), ("response", None)]


def test_a_url_that_most_rows_ask_for_loses_and_doubles_nothing(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "http://hot").otherwise(F.concat(F.lit("http://k"), F.col("id") % 500)).alias("url"),
        F.col("id").alias("url_pos"),
    )
    landed = rows.select("url").distinct().where("url <> 'http://k7'").withColumn("outcome", F.lit("ok"))
    got = fetch(rows, landed)
    assert got.count() == 3000
    assert {(r.url, r.outcome) for r in got.where("outcome <> 'ok'").collect()} == {("http://k7", "technical")}
