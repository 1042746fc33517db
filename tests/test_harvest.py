import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sheaf.operators.listings import PARSERS, dataset_urls, inline_entries, parse_listings
from sheaf.operators.reports import report_json
from sheaf.operators.routing import PUBLISHER_PATTERN, bad_publishers, publisher_name, route_of
from sheaf.plans.harvest import final_report, harvest, output_files, route_outputs
from sheaf.plans.staging import Stage, unstaged
from sheaf.schemas import RESPONSES
from sheaf.sinks.documents import write_documents, write_lines
from sheaf.sinks.snapshots import RunFailed, commit_message, publish, read_snapshot, read_snapshots
from sheaf.sources.catalog import repo_catalog
from sheaf.sources.files import scan_files

NS = "http://www.sitemaps.org/schemas/sitemap/0.9"
AT = datetime(2024, 1, 2, 3, 4, 5, 123456)


def sitemap(*locations):
    urls = "".join(f"<url><loc>{loc}</loc><lastmod>2024</lastmod></url>" for loc in locations)
    return f'<?xml version="1.0" encoding="ISO-8859-1"?><urlset xmlns="{NS}">{urls}</urlset>'


def page(*objects):
    blocks = "".join(f'<script type="application/ld+json">{json.dumps(o)}</script>' for o in objects)
    return f"<html><body>{blocks}</body></html>"


LISTINGS = [
    ("xml", sitemap("http://a", "\n http://b \n", "http://a"), ["http://a", "\n http://b \n", "http://a"], None, None),
    ("xml", f'<sitemapindex xmlns="{NS}"><sitemap><loc>http://i</loc></sitemap></sitemapindex>', ["http://i"], None, None),
    ("xml", f'<x:urlset xmlns:x="{NS}"><x:url><x:loc>a&amp;b</x:loc><x:loc/></x:url></x:urlset>', ["a&b"], None, None),
    ("xml", "<urlset><url><loc>http://no-namespace</loc></url></urlset>", [], None, None),
    ("xml", sitemap("http://a") + "junk", None, None, "repo"),
    ("xml", "", None, None, "repo"),
    ("openagrar", '{"response":{"docs":[{"id":"m_1"},{"id":2},{"id":null},{"id":true}]}}',
     [f"https://www.openagrar.de/receive/{x}" for x in ("m_1", "2", "None", "True")], None, None),
    ("openagrar", '{"response":{"docs":[]}}', [], None, None),
    ("openagrar", '{"response":{"docs":[{"id":"a"},{}]}}', None, None, "repo"),
    ("openagrar", '{"response":{"docs":{"id":"a"}}}', None, None, "repo"),
    ("openagrar", '{"response":{"docs": {} }}', [], None, None),
    ("openagrar", '{"response":{"docs":""}}', [], None, None),
    ("openagrar", '{"response":{"docs":"a"}}', None, None, "repo"),
    ("openagrar", '{"response":{"docs":0}}', None, None, "repo"),
    ("openagrar", '{"response":{"docs":null}}', None, None, "repo"),
    ("openagrar", '{"response":{}}', None, None, "repo"),
    ("openagrar", "[]", None, None, "repo"),
    ("openagrar", "no json", None, None, "repo"),
    ("publisso", '[{"b": 1, "a": 2.0}, 5]', None, ['{"a":2.0,"b":1}', "5"], None),
    ("publisso", '{"a": []}', None, ['{"a":[]}'], None),
    ("publisso", "null", None, ["null"], None),
    ("publisso", "[]", None, [], None),
    ("publisso", "", None, None, "repo"),
    ("publisso", "[1", None, None, "repo"),
    ("thunen_atlas", '{"resources": [{"a": 1}]}', None, ['{"a":1}'], None),
    ("thunen_atlas", '{"resources": {"a": 1.50}}', None, ['{"a":1.5}'], None),
    ("thunen_atlas", '{"resources": null}', None, ["null"], None),
    ("thunen_atlas", '{"other": []}', None, None, "run"),
    ("thunen_atlas", "[1]", None, None, "run"),
    ("thunen_atlas", "{", None, None, "repo"),
    ("unheard-of", "{}", None, None, "run"),
]


def test_listings(spark):
    rows = [(i, key, "jsonld", content) for i, (key, content, *_) in enumerate(LISTINGS)]
    df = spark.createDataFrame(rows, "i int, sitemap string, metadata string, content string")
    got = parse_listings(df).orderBy("i").collect()
    for row, (key, content, urls, items, scope) in zip(got, LISTINGS, strict=True):
        assert (row.urls, row.items, row.scope) == (urls, items, scope), (key, content)
        mode = "none" if scope else "inline" if items is not None else "crawl"
        assert row.mode == mode


def test_listing_errors_keep_their_order(spark):
    rows = [
        ("technical", "unheard-of", None, None),  # the fetch failed before the key was looked at
        ("ok", "xml", "unheard-of", "broken"),  # so did the listing before the extractor's key
        ("ok", "xml", "unheard-of", sitemap("http://a")),
        ("ok", "publisso", "unheard-of", "[1]"),  # records need no extractor
        ("ok", "xml", None, sitemap("http://a")),
    ]
    df = spark.createDataFrame(rows, "outcome string, sitemap string, metadata string, content string")
    got = parse_listings(df.withColumn("name", F.lit("r")), extractor_keys=("jsonld",))
    assert [(r.scope, r.mode) for r in got.collect()] == [
        ("repo", "none"), ("repo", "none"), ("run", "none"), (None, "inline"), (None, "none"),
    ]
    assert dataset_urls(got).count() == 0 and inline_entries(got).count() == 1


def test_user_parser(spark):
    def lines(df):
        nothing = F.lit(None).cast("array<string>")
        return df.withColumns(
            {"urls": F.split("content", "\n"), "items": nothing, "problem": F.lit(None).cast("string")}
        )

    df = spark.createDataFrame([("r", "lines", "jsonld", "http://a\nhttp://b")], "name string, sitemap string, metadata string, content string")
    urls = dataset_urls(parse_listings(df, {**PARSERS, "lines": lines}))
    assert [(r.url_pos, r.url) for r in urls.orderBy("url_pos").collect()] == [(0, "http://a"), (1, "http://b")]


def test_routes_and_publishers(spark):
    names = ["publisso_native", "openagrar_publisso", "x-openagrar", "OpenAgrar", "edal"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.r for r in df.select(route_of(F.col("n")).alias("r")).collect()] == [
        "reshape", "reshape", "split", "generic", "generic"
    ]
    cases = {
        '{"publisher":{"name":"Johann Heinrich von THÜNEN INSTITUT"}}': True,
        '{"publisher":{"name":"Thünen-Institut für Ökologie"}}': True,
        '{"publisher":{"name":"ThünenInstitut"}}': True,
        '{"publisher":{"name":"Thuenen-Institute"}}': False,
        '{"publisher":{"name":"Thünen  Institut"}}': False,
        '{"n":NaN,"publisher":{"name":"thünen-atlas"}}': True,
        '{"publisher":{}}': False,
        "{}": False,
    }
    df = spark.createDataFrame([(t,) for t in cases], "entry string")
    hit = publisher_name(F.col("entry")).rlike(PUBLISHER_PATTERN)
    assert [r.h for r in df.select(hit.alias("h")).collect()] == list(cases.values())
    assert bad_publishers(df).isEmpty()


GOOD = {"@context": "https://schema.org", "@type": "Dataset", "name": "one"}


@pytest.fixture(scope="module")
def inputs(spark):
    config = [
        {"name": "soil", "url": "http://l/soil", "sitemap": "xml", "metadata": "embedded_jsonld"},
        {"name": "quiet", "url": "http://l/quiet", "sitemap": "xml", "metadata": "embedded_jsonld", "commit": False},
        {"name": "down", "url": "http://l/down", "sitemap": "xml", "metadata": "embedded_jsonld"},
        {"name": "broken", "url": "http://l/broken", "sitemap": "xml", "metadata": "embedded_jsonld"},
        {"name": "lost", "url": "http://l/lost", "sitemap": "xml", "metadata": "embedded_jsonld"},
        {"name": "plain", "url": "http://l/soil", "sitemap": "xml"},
        {"name": "empty", "url": "http://l/empty", "sitemap": "xml", "metadata": "jsonld"},
        {"name": "openagrar_native", "url": "http://l/ids", "sitemap": "openagrar", "metadata": "jsonld"},
        {"name": "publisso_native", "url": "http://l/records", "sitemap": "publisso"},
        {"name": "odd", "url": "gopher://l", "sitemap": "xml", "metadata": "jsonld"},
    ]
    two = [{"name": "b"}, {"name": "a", "z": 1, "c": [None]}]
    records = [
        {"doi": "10.1/x", "title": ["t1", "t2"]},
        {"doi": "10.1/y", "title": []},
        {"title": ["no id"]},
        {"doi": "10.1/z"},
    ]
    bodies = {
        "http://l/soil": sitemap("http://p/1", "\n http://p/2\n", "http://p/gone", "http://p/1", "http://p/bad"),
        "http://l/quiet": sitemap("http://p/1", "http://p/none"),
        "http://l/down": sitemap("http://p/1", "http://p/500"),
        "http://l/broken": "<urlset>",
        "http://l/empty": sitemap(),
        "http://l/ids": json.dumps({"response": {"docs": [{"id": i} for i in "abcd"]}}),
        "http://l/records": json.dumps(records),
        "http://p/1": page(GOOD),
        "http://p/2": page(two),
        "http://p/bad": '<script type="application/ld+json">{</script>',
        "http://p/none": "<html/>",
        "https://www.openagrar.de/receive/a": json.dumps({"publisher": {"name": "Thünen-Institut"}}),
        "https://www.openagrar.de/receive/b": json.dumps({"publisher": {"name": "JKI"}}),
        "https://www.openagrar.de/receive/c": "not json",
        "https://www.openagrar.de/receive/d": json.dumps([{}, {"publisher": {}}]),
    }
    rows = [(url, 200, bytearray(body.encode()), None) for url, body in bodies.items()]
    rows += [("http://p/gone", 404, None, None), ("http://p/500", 503, None, None)]
    return repo_catalog(spark, config), spark.createDataFrame(rows, RESPONSES)


@pytest.fixture(scope="module")
def done(inputs):
    return harvest(*inputs)


def test_run_report(done):
    rows = final_report(done.reports, done.entries).collect()
    got = [(r.repo_name, r.valid_entries, r.failed_entries, r.skipped) for r in rows]
    assert got == [
        ("soil", 4, 1, False),
        ("quiet", 1, 1, False),
        ("down", 0, 0, True),
        ("broken", 0, 0, True),
        ("lost", 0, 0, True),
        ("plain", 0, 0, True),
        ("empty", 0, 0, False),
        ("thunen_atlas", 1, 0, False),
        ("openagrar", 3, 0, False),
        ("publisso", 4, 0, False),
        ("odd", 0, 0, True),
    ]
    text = report_json(final_report(done.reports, done.entries)).collect()[0].report
    assert text == '{"failed_entries":1,"repo_name":"soil","skipped":false,"valid_entries":4}'
    assert done.run_errors.count() == 0


def test_failed_may_be_negative(spark):
    repos = repo_catalog(spark, [{"name": "r", "url": "http://l", "sitemap": "xml", "metadata": "jsonld"}])
    rows = [("http://l", 200, bytearray(sitemap("http://p").encode()), None), ("http://p", 200, bytearray(b"[1,2,3]"), None)]
    done = harvest(repos, spark.createDataFrame(rows, RESPONSES), stage=unstaged)
    report = done.reports.collect()[0]
    assert (report.valid_entries, report.failed_entries) == (3, -2)


def test_entries_and_dead_letters(done):
    soil = done.entries.where("repo = 'soil'").orderBy("url_pos", "item_pos").collect()
    first = '{"@context":"https://schema.org","@type":"Dataset","name":"one"}'
    assert [(r.url_pos, r.item_pos, r.entry) for r in soil] == [
        (0, 0, first), (1, 0, '{"name":"b"}'), (1, 1, '{"c":[null],"name":"a","z":1}'), (3, 0, first)
    ]
    rows = done.dead_letters.collect()
    causes = {r.repo: (r.scope, r.outcome) for r in rows if r.scope != "dataset"}
    assert causes["broken"] == ("listing: repo", "malformed")
    assert {k: v[1] for k, v in causes.items()} == {
        "broken": "malformed", "down": "technical", "lost": "technical", "odd": "argument"
    }
    letters = {(r.repo, r.url_pos): (r.outcome, r.suspicious_data) for r in rows if r.scope == "dataset"}
    assert letters == {
        ("soil", 2): ("response", None), ("soil", 4): ("parse", "{"), ("openagrar_native", 2): ("parse", "not json"),
    }


def test_outputs(spark, inputs, done, tmp_path):
    outputs = route_outputs(done.entries)
    files = output_files(done.reports, inputs[0], outputs)
    assert {(r.repo, r.file_name, r.published, r.row_count) for r in files.collect()} == {
        ("soil", "soil.json", True, 4),
        ("quiet", "quiet.json", False, 1),
        ("openagrar_native", "openagrar_native.json", False, 4),
        ("openagrar_native", "thunen_atlas.json", True, 1),
        ("openagrar_native", "openagrar.json", True, 3),
        ("publisso_native", "publisso_native.json", False, 4),
        ("publisso_native", "publisso.json", True, 2),
    }
    write_documents(outputs, str(tmp_path / "docs"), indent=2, partitions=3)
    parts = sorted((tmp_path / "docs" / "repo=soil" / "file_name=soil.json").glob("part-*"))
    text = "".join(part.read_text() for part in parts)
    two = [{"name": "b"}, {"name": "a", "z": 1, "c": [None]}]
    assert text.rstrip("\n") == json.dumps([GOOD, *two, GOOD], indent=2, sort_keys=True)
    write_documents(outputs, str(tmp_path / "compact"), files.select("repo", "file_name"), partitions=3)
    for folder in (tmp_path / "compact").glob("repo=*/file_name=*"):
        json.loads("".join(part.read_text() for part in sorted(folder.glob("part-*"))))
    write_lines(outputs, str(tmp_path / "lines"))
    names = {p.name for p in (tmp_path / "lines").glob("repo=*/file_name=*")}
    assert "file_name=empty.json" not in names and len(names) == 7


def test_publish(spark, inputs, done, tmp_path):
    root = str(tmp_path / "versions")
    outputs = route_outputs(done.entries)
    files = output_files(done.reports, inputs[0], outputs)
    publish(outputs, files, done.run_errors, root, AT, "tests")
    later = AT.replace(day=3)
    publish(outputs, files, done.run_errors, root, later, "tests")
    rows = read_snapshots(spark, root).collect()
    assert len(rows) == 8 and {r.file_name for r in rows} == {
        "soil.json", "thunen_atlas.json", "openagrar.json", "publisso.json"
    }
    message = "harvested by tests at 2024-01-02 03:04:05.123456 UTC+0000 from http://l/soil"
    assert message in {r.message for r in rows}
    assert read_snapshot(spark, root, AT, "soil.json").count() == 4
    assert read_snapshot(spark, root, later, "publisso.json").count() == 2


def test_message_is_in_utc(spark):
    df = spark.sql("SELECT timestamp_micros(1704164645123456) AS at, timestamp_micros(-1) AS early")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = df.select(
            commit_message("x", F.col("at"), F.lit("u")).alias("a"),
            commit_message("x", F.col("early"), F.lit("u")).alias("b"),
        ).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.a == "harvested by x at 2024-01-02 03:04:05.123456 UTC+0000 from u"
    assert row.b == "harvested by x at 1969-12-31 23:59:59.999999 UTC+0000 from u"


def test_a_run_error_publishes_nothing(spark, tmp_path):
    config = [
        {"name": "fine", "url": "http://l/1", "sitemap": "publisso"},
        {"name": "bad", "url": "http://l/1", "sitemap": "thunen_atlas"},
    ]
    rows = [("http://l/1", 200, bytearray(b'[{"a":1}]'), None)]
    repos = repo_catalog(spark, config)
    done = harvest(repos, spark.createDataFrame(rows, RESPONSES), stage=unstaged)
    outputs = route_outputs(done.entries)
    files = output_files(done.reports, repos, outputs)
    with pytest.raises(RunFailed):
        publish(outputs, files, done.run_errors, str(tmp_path / "v"), AT)
    assert not (tmp_path / "v").exists()


def test_publisher_of_wrong_type_is_a_run_error(spark):
    config = [{"name": "openagrar", "url": "http://l", "sitemap": "publisso"}]
    body = bytearray(b'[{"publisher":{"name":5}},{"publisher":"x"},{"publisher":{}}]')
    done = harvest(repo_catalog(spark, config), spark.createDataFrame([("http://l", 200, body, None)], RESPONSES), stage=unstaged)
    assert done.run_errors.count() == 2


def test_golden_files(spark, tmp_path):
    (tmp_path / "site").mkdir()
    (tmp_path / "site" / "map.xml").write_text(sitemap("\n    file://./site/entry.html\n"))
    (tmp_path / "site" / "entry.html").write_text(page(GOOD))
    config = [{"name": "test", "url": "file://./site/map.xml", "sitemap": "xml", "metadata": "embedded_jsonld"}]
    done = harvest(
        repo_catalog(spark, config),
        spark.createDataFrame([], RESPONSES),
        scan_files(spark, str(tmp_path)),
        base_dir=str(tmp_path),
        stage=Stage(spark, str(tmp_path / "stage")),
    )
    row = final_report(done.reports, done.entries).collect()[0]
    assert (row.repo_name, row.valid_entries, row.failed_entries, row.skipped) == ("test", 1, 0, False)


def test_two_repositories_on_one_route_have_documents_of_their_own(spark, tmp_path):
    rows = [(repo, i, 0, f'{{"n":{i}}}') for repo in ("openagrar-a", "openagrar-b", "publisso-a") for i in range(5)]
    entries = spark.createDataFrame(rows, "repo string, url_pos int, item_pos int, entry string")
    outputs = route_outputs(entries)
    files = spark.createDataFrame([("publisso-a", "publisso.json"), ("openagrar-b", "thunen_atlas.json")], "repo string, file_name string")
    write_documents(outputs, str(tmp_path / "docs"), files)
    found = {}
    for folder in (tmp_path / "docs").glob("repo=*/file_name=*"):
        text = "".join(part.read_text() for part in sorted(folder.glob("part-*")))
        found[folder.parent.name[5:], folder.name[10:]] = json.loads(text)
    assert found["openagrar-a", "openagrar.json"] == found["openagrar-b", "openagrar.json"] == [{"n": i} for i in range(5)]
    assert found["publisso-a", "publisso.json"] == found["openagrar-b", "thunen_atlas.json"] == []


def test_a_stage_removes_its_tables(spark, tmp_path):
    with Stage(spark, str(tmp_path)) as stage:
        assert stage(spark.range(3), "t").count() == 3
        assert len(list(tmp_path.iterdir())) == 1
    assert not list(tmp_path.iterdir())
