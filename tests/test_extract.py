import json

import pytest
from pyspark.sql import functions as F

from sheaf.functions.html import jsonld_blocks
from sheaf.operators.extract import EXTRACTORS, extract_by_key

LD = '<script type="application/ld+json">{}</script>'
ONE = '{"@type": "Dataset", "name": "Yields 2019", "@context": "https://schema.org"}'
TWO = '[{"name": "first"}, {"name": "second"}]'


def page(*blocks):
    return "<html><head><title>x</title></head><body>" + "".join(blocks) + "</body></html>"


def run_all(spark, key, contents):
    rows = [(pos, key, content) for pos, content in enumerate(contents)]
    df = spark.createDataFrame(rows, "url_pos int, metadata string, content string")
    got = extract_by_key(df).orderBy("url_pos").collect()
    return [(row.outcome, row.entries, row.raw) for row in got]


def run(spark, key, content):
    return run_all(spark, key, [content])[0]


EMBEDDED = [
        (page(LD.format(ONE)), "ok", [json.loads(ONE)]),
        (page(LD.format(TWO)), "ok", json.loads(TWO)),
        (page(LD.format(ONE), "<p>", LD.format(TWO)), "ok", [json.loads(ONE), *json.loads(TWO)]),
        (page(), "ok", []),
        (page(LD.format("  \n ")), "parse", None),
        (page(LD.format("no json")), "parse", None),
        (page(LD.format(ONE), LD.format("{oops")), "parse", None),
        (page(LD.format('"text"'), LD.format("7"), LD.format("null")), "ok", []),
        (page(LD.format('[{}, 0, "", null, {"a": 1}, "kept"]')), "ok", [{"a": 1}, "kept"]),
        (page(LD.format('{"a": "line\nbreak"}')), "ok", [{"a": "line\nbreak"}]),
        (page(LD.format('// note\n{"a": 1, /* x */ "b": "/*no*/",}')), "ok", [{"a": 1, "b": "/*no*/"}]),
        (page("<!-- " + LD.format("bad") + " -->", LD.format(ONE)), "ok", [json.loads(ONE)]),
        (page("<script>var s = '<script type=\"application/ld+json\">';</script>"), "ok", []),
        (page("<SCRIPT  data-a='>' TYPE='application/ld+json'>" + ONE + "</SCRIPT >"), "ok", [json.loads(ONE)]),
        (page("<script type=application/ld+json async>" + ONE + "</script>"), "ok", [json.loads(ONE)]),
        (page('<script type="application/LD+json">bad</script>'), "ok", []),
        (page('<script data-type="application/ld+json">bad</script>'), "ok", []),
        ("<html><body><div><p>" + LD.format(ONE) + "</span></body>", "ok", [json.loads(ONE)]),
        ('<script type="application/ld+json">' + ONE, "ok", [json.loads(ONE)]),
        (page(LD.format('{"n": 1.0, "e": 1e3, "big": 123456789012345678901234567890123456789012}')), "ok",
         [{"n": 1.0, "e": 1000.0, "big": 123456789012345678901234567890123456789012}]),
        (page(LD.format('{"a": 1, "a": 2}')), "ok", [{"a": 2}]),
]


@pytest.fixture(scope="module")
def embedded(spark):
    return run_all(spark, "embedded_jsonld", [html for html, _, _ in EMBEDDED])


@pytest.mark.parametrize("case", range(len(EMBEDDED)))
def test_embedded(embedded, case):
    _, outcome, entries = EMBEDDED[case]
    got, texts, raw = embedded[case]
    assert got == outcome
    if entries is None:
        assert texts is None and raw is not None
    else:
        want = [json.dumps(e, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for e in entries]
        assert texts == want and raw is None


STANDALONE = [
        (ONE, [json.loads(ONE)]),
        (TWO, json.loads(TWO)),
        ("", None),
        ("not json", None),
        ('{"a": 1} trailing', None),
        ("1],[2", None),
        ("1, 2", None),
        ("[1,2,]", None),
        ("true", [True]),
        ("null", [None]),
        ("5", [5]),
        ("1.0", [1.0]),
        ("[]", []),
        ("NaN", [float("nan")]),
        ('{"a": 1, "a": {"b": null}}', [{"a": {"b": None}}]),
        ('{"z": "\\u001f \\u00e9 / \\"", "a": [3, 2.50]}', [{"z": '\u001f é / "', "a": [3, 2.5]}]),
        ('﻿{"a": 1}', None),
        ('{"a": "x\ny"}', None),
]


@pytest.fixture(scope="module")
def standalone(spark):
    return run_all(spark, "jsonld", [content for content, _ in STANDALONE])


@pytest.mark.parametrize("case", range(len(STANDALONE)))
def test_standalone(standalone, case):
    content, entries = STANDALONE[case]
    outcome, texts, raw = standalone[case]
    if entries is None:
        assert (outcome, texts, raw) == ("parse", None, [content])
    else:
        want = [json.dumps(e, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for e in entries]
        assert (outcome, texts, raw) == ("ok", want, None)


def test_lone_surrogate_is_kept_as_an_escape(spark):
    assert run(spark, "jsonld", '{"a": "\\ud800"}')[1] == ['{"a":"\\ud800"}']


def test_raw_blocks(spark):
    html = page(LD.format("  "), LD.format("no json"), LD.format(ONE))
    df = spark.createDataFrame([(html,)], "html string").select(jsonld_blocks(F.col("html")).alias("b"))
    assert df.collect()[0].b == ["  ", "no json", ONE]


def test_long_and_broken_pages(spark):
    many = page(*(LD.format(ONE) for _ in range(2000)), "<!-- open " * 2000)
    tag = page("<script " + " ".join(f'a{i}="v>{i}"' for i in range(3000)) + ' type="application/ld+json">' + ONE + "</script>")
    df = spark.createDataFrame([(many,), (tag,)], "html string").select(F.size(jsonld_blocks(F.col("html"))).alias("n"))
    assert [row.n for row in df.collect()] == [2000, 1]


def test_unknown_extractor_and_user_extractor(spark):
    assert run(spark, "nope", ONE)[0] == "unknown_key"

    def by_line(df):
        return df.withColumn("entries", F.split("content", "\n")).withColumn("raw", F.array("content"))

    df = spark.createDataFrame([("lines", "1\n2"), ("jsonld", "[3]")], "metadata string, content string")
    got = extract_by_key(df, {**EXTRACTORS, "lines": by_line}).collect()
    assert [row.entries for row in got] == [["1", "2"], ["3"]]
