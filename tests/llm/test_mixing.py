from collections import Counter, defaultdict
from math import comb

import numpy as np
import pytest

from sheaf.llm import mixing
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, spaced, text, with_clashes


def corpus(spark, n=400):
    rows = [(i, text(i, 5 + i * 7 % 60), "en", ("a", "b", "b", "b", None, "ü")[i % 6], 0) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_targets():
    assert mixing.targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    assert mixing.targets([10, 1000, 1000]) == pytest.approx([30, 1980 * 2 / 3, 1980 / 3])
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]
    assert sum(mixing.targets([1, 2, 3, 400, 5, 6, 0])) == pytest.approx(417)


@pytest.mark.parametrize("shards", [1, 2, 7, 32])
def test_the_tree_deals_each_unit_to_one_shard_by_exact_quotas(shards):
    tree = mixing.Tree(np.array([100, 0, 37, 863]), shards)
    sources = np.repeat([0, 2, 3], [100, 37, 863])
    units = np.concatenate([np.arange(100), np.arange(37), np.arange(863)])
    found = tree.locate(sources, units)
    sizes = np.bincount(found, minlength=shards)
    assert sizes.max() - sizes.min() <= 1
    for s in (0, 2, 3):
        assert (np.diff(found[sources == s]) >= 0).all()
    assert (tree.locate(sources[500:510], units[500:510]) == found[500:510]).all()


def test_large_draws_are_exact(monkeypatch):
    quotas = np.array([3 * 10**12, 10**12, 0, 5])
    left = mixing.drawn(np.random.default_rng(1), quotas, 10**12)
    assert left.sum() == 10**12 and (left <= quotas).all() and left[2] == 0
    assert 0 < abs(left[0] - 75 * 10**10) < 6 * 433_013  # standard deviation of the hypergeometric draw
    tree = mixing.Tree(np.array([3 * 10**9, 10**9]), 4)
    assert tree.split(tree.quotas, 0, 2, 4).sum() == 2 * 10**9
    # The same way on small numbers gives the hypergeometric distribution.
    monkeypatch.setattr(mixing, "LARGEST_DRAW", 0)
    monkeypatch.setattr(mixing, "FEW", 2)
    rng, quotas = np.random.default_rng(2), np.array([6, 4, 2])
    counts = Counter(tuple(mixing.drawn(rng, quotas, 5)) for _ in range(20_000))
    for (a, b, c), n in counts.items():
        assert a + b + c == 5
        want = comb(6, a) * comb(4, b) * comb(2, c) / comb(12, 5)
        assert abs(n / 20_000 - want) < 5 * (want / 20_000) ** 0.5
    assert len(counts) == sum(1 for a in range(6) for b in range(5) if 0 <= 5 - a - b <= 2)


def test_splits_are_drawn_once(monkeypatch):
    tree = mixing.Tree(np.array([100, 37]), 16)
    first = tree.locate(np.zeros(100, dtype=int), np.arange(100))
    monkeypatch.setattr(mixing, "drawn", None)
    assert (tree.locate(np.zeros(100, dtype=int), np.arange(100)) == first).all()


def test_long_documents_meet_the_targets(spark):
    sizes = [("a", 3000), ("a", 5000), ("b", 9000), ("b", 1), ("c", 4000), ("c", 0), ("c", 2500)]
    docs = spark.createDataFrame([(i, text(i, n), "en", s, 0) for i, (s, n) in enumerate(sizes)], SCHEMA)
    got = mixing.mixed_sizes(docs).collect()
    # 23,501 words by 5 : 2 : 1, by hand.
    want = {8000: 14_688.125, 9001: 5_875.25, 6500: 2_937.625}
    for size, target in want.items():
        assert abs(sum(r.taken for r in got if r.source_size == size) - target) <= 0.5
        assert {r.target for r in got if r.source_size == size} == {target}
    assert all(r.taken <= 3 * r["size"] for r in got)
    rows = mixing.mix(docs, cut="cut_").collect()
    words = Counter()
    for r in rows:
        words[r.doc_id] += len(spaced(r.text))
        assert r.cut_ == (len(spaced(r.text)) < sizes[r.doc_id][1])
    assert words == Counter({r.doc_id: r.taken for r in got if r.taken})
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(whole[r.doc_id].startswith(r.text) for r in rows) and sum(r.cut_ for r in rows) <= 3


def test_the_tree_draws_without_bias():
    total = sum(mixing.Tree(np.array([60, 40]), 2, seed).split(np.array([60, 40]), 0, 1, 2)[0] for seed in range(300))
    assert abs(total / 300 - 30) < 1


def test_sizes_and_targets_against_brute_force(spark):
    docs, rows = corpus(spark)
    got = mixing.mixed_sizes(docs).collect()
    size = {r[0]: len(spaced(r[1])) for r in rows}
    source = {r[0]: r[3] for r in rows}
    sums = Counter()
    for i, n in size.items():
        sums[source[i]] += n
    names = sorted((s for s in sums if s is not None)) + [None]
    target = dict(zip(names, mixing.targets([sums[s] for s in names]), strict=True))
    taken = Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == sums[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= 0.5
    parts = Counter(source[r.doc_id] for r in got if r.taken % max(1, r["size"]))
    assert max(parts.values(), default=0) <= 1
    again = mixing.mixed_sizes(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_takes_what_the_sizes_say(spark):
    docs, _ = corpus(spark)
    taken = {r.doc_id: -(-r.taken // r["size"]) for r in mixing.mixed_sizes(docs, shard_words=2000).collect()}
    rows = mixing.mix(docs, shard_words=2000).collect()
    assert Counter(r.doc_id for r in rows) == Counter({i: n for i, n in taken.items() if n})
    shards, words = defaultdict(list), Counter()
    for r in rows:
        shards[r.shard].append(r.position)
        words[r.shard] += len(spaced(r.text))
    assert all(sorted(p) == list(range(len(p))) for p in shards.values())
    assert len(words) == -(-sum(words.values()) // 2000) or abs(len(words) - sum(words.values()) / 2000) <= 1
    assert max(words.values()) < 2 * min(words.values())


def test_a_source_in_many_buckets(spark, monkeypatch):
    docs, _ = corpus(spark)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    got = mixing.mixed_sizes(docs).collect()
    by = defaultdict(lambda: [0, 0.0])
    for r in got:
        by[r.source_size, r.target][0] += r.taken
    assert all(abs(taken - target) <= 0.5 for (_, target), (taken, _) in by.items())


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "shard_", "position_"]
    assert mixed.where("rank != 'rank' OR `order` != 'order' OR size != 'size'").count() == 0
    got = mixing.mixed_sizes(docs).collect()
    assert len(got) == docs.count()
    assert {r["size"] for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mixed_sizes(no_docs(spark)).collect() == [] and mixing.mix(no_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        mixing.MAX_SOURCES, before = 2, mixing.MAX_SOURCES
        try:
            mixing.mixed_sizes(odd_docs(spark))
        finally:
            mixing.MAX_SOURCES = before


def test_the_sources_need_no_python_workers_of_their_own(spark, monkeypatch):
    docs, rows = corpus(spark)

    def refused(*_, **__):
        raise AssertionError("rows went through an RDD of Python objects")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    found = mixing.mixed_sizes(docs)
    assert [f.simpleString() for f in found.schema if f.name in ("source_size", "target")] == ["source_size:bigint", "target:double"]
    assert {r.doc_id for r in found.collect()} == {r[0] for r in rows}
    assert mixing.mixed_sizes(docs.where("false")).collect() == []
