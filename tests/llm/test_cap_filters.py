import numpy as np
import pytest

from sheaf.llm import cap_filters

SCHEMA = "vec_id long, embedding array<float>, label int"


def near(rng, vector, cosine):
    other = rng.normal(size=len(vector))
    other -= other @ vector * vector / (vector @ vector)
    return cosine * vector / np.linalg.norm(vector) + (1 - cosine**2) ** 0.5 * other / np.linalg.norm(other)


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors], SCHEMA)


def slow(vectors, limit=0.9):
    """Links and smallest reachable id of each row, pair by pair."""
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in vectors]
    links, root = [0] * len(good), list(range(len(good)))
    for a in range(len(good)):
        for b in range(len(good)):
            x, y = good[a][1], good[b][1]
            if a != b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= limit:
                links[a] += 1
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return [(i, links[k], min(good[j][0] for j in range(len(good)) if root[j] == root[k])) for k, (i, _) in enumerate(good)]


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(7)
    vectors = []
    for _ in range(25):
        centre = rng.normal(size=64)
        vectors += [near(rng, centre, c) for c in (0.96, 0.97, 0.99)] + [centre]
    vectors += [vectors[0]] * 30 + [2 * vectors[4]] * 3
    start = rng.normal(size=64)
    for _ in range(12):  # a chain
        start = near(rng, start, 0.93)
        vectors.append(start)
    return list(enumerate(vectors))[::-1]


def test_against_all_pairs(spark, clustered):
    got = cap_filters.near_duplicates(frame(spark, clustered)).collect()
    want = {i: (links, component) for i, links, component in slow(clustered)}
    # A pair near the limit may be missed; whatever is found is right.
    assert all(r.n_links <= want[r.vec_id][0] and r.component_id == want[r.vec_id][1] for r in got)
    assert sum(r.n_links for r in got) >= 0.98 * sum(links for links, _ in want.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_parts_of_a_cap_change_nothing(spark, clustered):
    few, many = (cap_filters.near_duplicates(frame(spark, clustered), part_rows=n).collect() for n in (5, 1024))
    assert sorted(few) == sorted(many)


def test_recall_of_pairs_at_the_limit():
    rng = np.random.default_rng(9)
    code = cap_filters.Code.of(64)
    first = cap_filters.unit(rng.normal(size=(400, 64)))
    second = np.stack([near(rng, v, 0.9) for v in first])
    met = [bool(set(a) & set(b)) for a, b in zip(code.caps(first), code.caps(second), strict=True)]
    assert np.mean(met) >= 0.95


def test_caps_are_all_directions_beyond_the_threshold():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 64):
        code = cap_filters.Code.of(size, 16)
        vectors = cap_filters.unit(rng.normal(size=(20, size)))
        directions = np.array([[*u, *v] for u in code.words[0] for v in code.words[1]])
        assert np.linalg.norm(directions, axis=1) == pytest.approx(np.ones(len(directions)))
        scores = vectors @ code.rotation @ directions.T
        for row, found in zip(scores, code.caps(vectors, 1.5), strict=True):
            beyond = np.flatnonzero(row >= 1.5 / size**0.5)
            if len(beyond) >= cap_filters.LEAST_CAPS:
                assert found.tolist() == beyond.tolist()
            else:
                assert set(beyond) <= set(found.tolist()) and len(found) >= min(cap_filters.LEAST_CAPS, len(directions))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    good = rng.normal(size=8)
    vectors = [(1, None), (2, []), (3, [0.0] * 8), (4, [nan] + [1.0] * 7), (5, [inf] + [1.0] * 7), (6, [None] + [1.0] * 7)]
    vectors += [(7, good), (7, good), (8, good), (None, good), (9, [1.0]), (10, [3.0]), (11, [-1.0]), (12, [1e-30] * 8), (13, [1e30] * 8)]
    got = cap_filters.near_duplicates(frame(spark, vectors).selectExpr("*", "'x' AS class", "1 AS copies", "2 AS caps")).collect()
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(vectors)
    assert all(by_id[i] == (0, i, True) for i in range(1, 7))
    assert by_id[7] == (3, 7, True) and by_id[8] == (3, 7, False) and by_id[None] == (3, 7, False)
    assert by_id[9] == (1, 9, True) and by_id[10] == (1, 9, False) and by_id[11] == (0, 11, True)
    assert by_id[12] == (1, 12, True) and by_id[13] == (1, 12, False)
    assert cap_filters.near_duplicates(frame(spark, [])).collect() == []
