from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from sheaf.llm import simhash
from sheaf.llm.components import connected_components
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, odd_rows, spaced, text, with_clashes


def slow_fingerprint(value, k=3):
    words = spaced(value)
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(keys, linked):
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def test_fingerprints(spark):
    short = [r for r in odd_rows() if r[0] != 7]
    got = simhash.fingerprints(odd_docs(spark).where("doc_id IS NULL OR doc_id != 7")).collect()
    want = sorted((r[0] or -1, slow_fingerprint(r[1])) for r in short)
    assert sorted((r.doc_id or -1, r.bits % (1 << 64)) for r in got) == want


def test_a_long_text_is_hashed_in_parts(monkeypatch):
    value = text(3, 5000).encode()
    whole = simhash.fingerprint(value)
    monkeypatch.setattr(simhash, "CHUNK_BYTES", 700)
    assert simhash.fingerprint(value) == whole


@pytest.mark.parametrize("large_bucket", [1, 3, 1000])
def test_links_find_all_pairs_of_any_bucket(spark, large_bucket):
    base = 0x1234_5678_9ABC_DEF0
    values = {base, base ^ 1, base ^ 3, base ^ 0xF, base ^ (1 << 63), base ^ (1 << 63) ^ (1 << 20), 0, 5, 7 << 40, (1 << 64) - 1}
    values |= {base ^ (1 << i) ^ (1 << j) for i in range(0, 64, 9) for j in range(3, 64, 17)}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "bits long"), 2, large_bucket)
    close = lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 2
    assert all(close(r.a, r.b) for r in edges.collect())
    got = {r.node: r.component for r in connected_components(edges).collect()}
    want = slow_components(sorted(signed), close)
    assert {v: got.get(v, v) for v in signed} == want


def test_near_duplicates(spark):
    got = defaultdict(set)
    for r in simhash.near_duplicates(odd_docs(spark)).collect():
        got[r.doc_id].add(r.component_id)
    assert got[1] == got[2] == got[3] == {1}
    assert got[4] == got[5] == {4}
    assert got[7] == {7}
    assert 1 in got[None]
    assert simhash.near_duplicates(no_docs(spark)).collect() == []


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    docs = with_clashes(odd_docs(spark))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 4, 6, 6, 7, 8, 9]
    assert sum(r.doc_id is None for r in rows) == 2
    assert simhash.drop_near_duplicates(no_docs(spark)).collect() == []


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 40)] + [(5, 5), (7, 1), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(path + hub, "x long, y long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 40)}}


def test_a_repeated_id_keeps_texts_that_are_no_near_duplicates(spark):
    rows = [(1, text(1, 80), "en", "a", 1), (2, text(2, 80), "en", "a", 1), (2, text(1, 80), "en", "a", 1), (3, text(3, 80), "fr", "b", 1), (3, text(4, 80), "en", "a", 1), (3, text(3, 80), "en", "a", 1), (None, text(1, 80), "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.rand())
    kept = sorted((str(r.doc_id), r.text, r.lang) for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == sorted([("1", text(1, 80), "en"), ("2", text(2, 80), "en"), ("3", text(3, 80), "en"), ("3", text(4, 80), "en"), ("None", text(1, 80), "en")])
