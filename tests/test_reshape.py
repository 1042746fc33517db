"""The reshape against a record-at-a-time model on odd records of every kind."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sheaf.operators.reshape import reshape

DOI = "https://doi.org/"
RESOURCE = "https://repository.publisso.de/resource/"


class Failure(Exception):
    pass


def iterate(value):
    if isinstance(value, list):
        return value
    if isinstance(value, dict):
        return [value[key] for key in sorted(value)]
    raise Failure


def read(value, key):
    if value is None:
        return None
    if not isinstance(value, dict):
        raise Failure
    return value.get(key)


def append(prefix, value):
    if value is None:
        return prefix
    if not isinstance(value, str):
        raise Failure
    return prefix + value


def first(value):
    if value is None:
        return None
    if not isinstance(value, list):
        raise Failure
    return value[0] if value else None


def truthy(value):
    return value is not None and value is not False


def person(member):
    label = read(member, "prefLabel")
    if not isinstance(label, str):
        raise Failure
    parts = label.split(", ") if label else []
    return {
        "@type": "Person",
        "familyName": parts[0] if parts else None,
        "givenName": " ".join(parts[1:]),
        "identifier": read(member, "@id"),
    }


def named(kind, **extra):
    def build(member):
        ident = {"DefinedTerm": "identifier"}.get(kind, "@id")
        return {"@type": kind, ident: read(member, "@id"), "name": read(member, "prefLabel"), **extra}

    return build


def part(member):
    inner = read(member, "@id")
    return {
        "@type": "DataDownload",
        "@id": append(RESOURCE, inner) if truthy(inner) else None,
        "name": read(member, "prefLabel"),
    }


def grant(member):
    return {
        "@type": "Grant",
        "name": read(member, "fundingProgramJoined"),
        "funder": named("Organization")(read(member, "fundingJoined")),
    }


def pruned(value):
    if isinstance(value, dict):
        return {k: pruned(v) for k, v in value.items() if v is not None}
    if isinstance(value, list):
        return [pruned(v) for v in value if v is not None]
    return value


def model(record):
    """Datasets of one record; raises Failure after those that come before the failure."""
    if not isinstance(record, dict) or ("doi" not in record and "@id" not in record):
        raise Failure

    def listed(name, build):
        return [build(m) for m in iterate(record[name])] if name in record else []

    out = {"@context": {"@language": "en", "@vocab": "https://schema.org/"}, "@type": "Dataset"}
    out["@id"] = append(DOI, record["doi"]) if "doi" in record else append(RESOURCE, record["@id"])
    for name in iterate(record["title"]) if "title" in record else [None]:
        headline = first(record.get("alternative"))
        for about in iterate(record["description"]) if "description" in record else [None]:
            identifier = []
            if "doi" in record:
                identifier.append(("https://registry.identifiers.org/registry/doi", record["doi"], DOI))
            if truthy(record.get("@id")):
                identifier.append(("frl-internal", record["@id"], RESOURCE))
            body = {
                "identifier": [
                    {"@type": "PropertyValue", "propertyID": p, "value": v, "url": append(u, v)}
                    for p, v, u in identifier
                ],
                "creator": listed("creator", person),
                "contributor": listed("contributor", person),
                "sourceOrganization": listed("institution", named("Organization")),
                "datePublished": record.get("issued"),
                "copyrightYear": first(record.get("yearOfCopyright")),
                "keywords": listed(
                    "ddc", named("DefinedTerm", inDefinedTermSet="https://www.oclc.org/en/dewey.html")
                )
                + listed("subject", named("DefinedTerm")),
                "measurementTechnique": listed("dataOrigin", named("DefinedTerm")),
                "funder": listed("fundingId", named("Organization")),
                "funding": listed("joinedFunding", grant)
                if "joinedFunding" in record
                else listed("fundingProgram", lambda m: {"@type": "Grant", "name": m}),
                "distribution": listed("hasPart", part),
                "inLanguage": listed("language", named("Language")),
            }
            for item in iterate(record["license"]) if "license" in record else [None]:
                licence = read(item, "@id")
                spatial = listed("recordingCoordinates", lambda m: {"@type": "Place", "url": read(m, "@id")})
                spatial += listed(
                    "recordingLocation",
                    lambda m: {"@type": "Place", "name": read(m, "prefLabel"), "url": read(m, "@id")},
                )
                yield pruned(
                    {**out, "name": name, "alternativeHeadline": headline, "description": about, **body,
                     "license": licence, "spatial": spatial}
                )


LISTS = (
    "creator contributor institution ddc subject dataOrigin fundingId joinedFunding hasPart language "
    "license recordingCoordinates recordingLocation"
).split()


def odd_record(rng, odd):
    def maybe(good, *bad):
        return rng.choice(bad) if bad and rng.random() < odd else good

    def member(name):
        label = rng.choice(["Doe, Jane", "Doe, J., M.", "Solo", "", "a, b, "])
        value = {"prefLabel": maybe(label, None, 7, ["x"]), "@id": maybe("id:1", None, False, True, 3)}
        if name == "joinedFunding":
            value = {"fundingProgramJoined": "p", "fundingJoined": maybe({"@id": "g"}, None, 4, [])}
        if rng.random() < odd:
            value.pop(rng.choice(sorted(value)))
        return maybe(value, None, "text", 5, [])

    record = {}
    if rng.random() < 0.8:
        record["doi"] = maybe("10.1/x", None, 5, {}, False)
    if rng.random() < 0.6:
        record["@id"] = maybe("frl:1", None, False, True, 7)
    for name in ("title", "description", "fundingProgram"):
        if rng.random() < 0.7:
            items = [maybe(f"{name} {i}", None, 4, True) for i in range(rng.choice([1, 1, 1, 2, 2, 3, 1, 2, 0]))]
            record[name] = maybe(items, None, "text", {"b": "x", "a": "y"}, 3)
    for name in ("alternative", "yearOfCopyright"):
        if rng.random() < 0.6:
            record[name] = maybe([2001, "b"], None, [], "text", {"a": 1}, 5)
    if rng.random() < 0.6:
        record["issued"] = maybe("2020-01-01", None, 2020, True)
    for name in LISTS:
        if rng.random() < 0.5:
            items = [member(name) for _ in range(rng.choice([1, 2, 2, 0]))]
            record[name] = maybe(items, None, "text", {"k": {"@id": "v", "prefLabel": "w, x"}}, 1)
    return maybe(record, None, [], "text")


def canonical(value):
    return json.dumps(value, sort_keys=True)


@pytest.mark.parametrize("on_error", ["truncate", "drop"])
def test_against_model(spark, on_error):
    rng = random.Random(7)
    rows, want = [], {}
    for number in range(150):
        repo, stopped = f"r{number}", False
        for pos in range(6):
            record = odd_record(rng, 0.004 if number % 2 else 0.02)
            rows.append((repo, pos, 0, json.dumps(record, sort_keys=True)))
            datasets, failed = [], False
            try:
                for dataset in model(record):
                    datasets.append(dataset)
            except Failure:
                failed = True
            if on_error == "drop":
                kept = [] if failed else datasets
            else:
                kept = [] if stopped else datasets
                stopped = stopped or failed
            if kept:
                want[repo, pos] = [canonical(dataset) for dataset in kept]
    assert len(want) > 100
    df = spark.createDataFrame(rows, "repo string, url_pos int, item_pos int, entry string")
    got = {}
    order = ("url_pos", "item_pos", "title_pos", "description_pos", "license_pos")
    for row in reshape(df, on_error).orderBy("repo", *order).collect():
        got.setdefault((row.repo, row.url_pos), []).append(canonical(json.loads(row.entry)))
    assert got == want


def test_key_order_and_empty_lists(spark):
    record = {"doi": "10.1/x", "title": ["t"], "creator": [{"prefLabel": "Doe, Jane"}]}
    df = spark.createDataFrame([("r", 0, 0, json.dumps(record))], "repo string, url_pos int, item_pos int, entry string")
    text = reshape(df).collect()[0].entry
    assert list(json.loads(text)) == [
        "@context", "@type", "@id", "name", "identifier", "creator", "contributor", "sourceOrganization",
        "keywords", "measurementTechnique", "funder", "funding", "distribution", "inLanguage", "spatial",
    ]
    assert '"creator":[{"@type":"Person","familyName":"Doe","givenName":"Jane"}]' in text


def test_unknown_error_mode(spark):
    with pytest.raises(ValueError):
        reshape(spark.createDataFrame([], "repo string, url_pos int, item_pos int, entry string"), "skip")


def test_constants_of_other_fields_and_nulls_further_down(spark):
    rows = [
        ("r", 0, '{"doi":"1","other":NaN,"title":["a"]}'),
        ("r", 1, '{"doi":"2","title":[{"a":null,"b":[null,{"c":null}],"s":":null,"}],"x":-Infinity}'),
        ("r", 2, '{"doi":"3","title":["c"]}'),
    ]
    records = spark.createDataFrame(rows, "repo string, url_pos int, entry string").withColumn("item_pos", F.lit(0))
    got = {r.url_pos: json.loads(r.entry)["name"] for r in reshape(records).collect()}
    assert got == {0: "a", 1: {"b": [{}], "s": ":null,"}, 2: "c"}


def test_records_of_joined_rows_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    from queries.corpora import people_records
    from sheaf.sources import splits

    spark.range(300).selectExpr("id AS o_orderkey", "id % 20 AS o_custkey", "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(20).selectExpr("id AS c_custkey", "'name' AS c_name", "'segment' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(splits, "TASK_ROWS", 50, raising=False)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Behind a shuffled join, small partitions were put together again.
        sizes = people_records(spark, str(tmp_path)).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert sum(sizes) == 300 and max(sizes) <= 60
