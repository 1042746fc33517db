import random

from sheaf.llm import decontaminate
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, text, with_clashes, words

ITEM = "item_id long, text string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], SCHEMA)


def replaced(value, every):
    parts = value.split()
    return " ".join(f"new{i}" if i % every == every // 2 else w for i, w in enumerate(parts))


def test_passages_are_found_with_replaced_words(spark):
    items = [(i, text(1000 + i, 30 + i, 5000)) for i in range(8)]
    texts = [(i, f"{text(i, 80, 5000)} {replaced(items[i][1], 6 + i).upper()}, {text(50 + i, 40, 5000)}") for i in range(8)]
    clean = [(100 + i, text(2000 + i, 200, 5000)) for i in range(30)]
    found = decontaminate.contaminations(docs_of(spark, texts + clean), spark.createDataFrame(items, ITEM)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(8)}
    for r in found:
        size = len(items[r.item_id][1].split())
        assert r.start - r.item_start == 80 and r.words >= size - 6 and r.equal >= 0.75 * r.words


def slow_pairs(texts, items, min_words, min_equal):
    """By looking at each alignment of each text with each item for the best stretch."""
    pairs = set()
    for i, value in texts:
        own = value.split()
        for j, item in items:
            other = item.split()
            for offset in range(-len(other), len(own)):
                run = [(own[k], other[k - offset]) for k in range(max(0, offset), min(len(own), offset + len(other)))]
                total = best = start = 0
                span = (0, 0)
                for k, (a, b) in enumerate(run):
                    total += 1 if a == b else -1.5
                    if total <= 0:
                        total, start = 0, k + 1
                    elif total > best:
                        best, span = total, (start, k + 1)
                length = span[1] - span[0]
                equal = sum(a == b for a, b in run[span[0] : span[1]])
                seven = any(all(a == b for a, b in run[k : k + 7]) for k in range(len(run) - 6))
                if seven and length >= min(min_words, len(other)) and equal >= min_equal * length:
                    pairs.add((i, j))
    return pairs


def test_exact_runs_against_all_alignments(spark):
    rng = random.Random(3)
    items = [(j, text(500 + j, rng.randrange(8, 25), 2000)) for j in range(6)]
    texts = []
    for i in range(25):
        own = words(i, 40, 2000)
        piece = rng.choice(items)[1].split()
        low = rng.randrange(len(piece))
        own[10:10] = piece[low : low + rng.randrange(5, 20)]
        texts.append((i, " ".join(own)))
    want = slow_pairs(texts, items, 12, 0.75)
    found = decontaminate.contaminations(docs_of(spark, texts), spark.createDataFrame(items, ITEM)).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in found}


def slow_rows(texts, items, min_words=12, min_equal=0.75):
    """All rows by looking at each alignment that some mask fits, and trying all its stretches."""
    rows = []
    for i, value in texts:
        own = value.split()
        for j, item in items:
            other = item.split()
            masks = decontaminate.MASKS if len(other) >= 7 else ("1" * len(other),)
            least = min(min_words, len(other))
            for offset in range(-len(other), len(own)):
                low, high = max(0, offset), min(len(own), offset + len(other))
                equal = [own[k] == other[k - offset] for k in range(low, high)]
                fits = any(all(equal[k + n] for n, c in enumerate(m) if c == "1") for m in masks for k in range(len(equal) - len(m) + 1))
                parts = [(0, len(equal))] if fits else []
                while parts:
                    a, b = parts.pop()
                    best = max(((sum(1 if x else -1.5 for x in equal[s:e]), -e, -s) for s in range(a, b) for e in range(s + 1, b + 1)), default=(0, 0, 0))
                    if best[0] > 0:
                        s, e = -best[2], -best[1]
                        same = sum(equal[s:e])
                        if e - s >= least and same >= min_equal * (e - s):
                            rows.append((i, j, low + s, e - s, low + s - offset, same))
                        parts += [(a, s), (e, b)]
    return sorted(rows)


def test_rows_against_all_stretches(spark):
    rng = random.Random(4)
    items = [(j, text(500 + j, size, 2000)) for j, size in enumerate([3, 5, 6, 7, 11, 12, 20, 45, 45])]
    texts = []
    for i in range(30):
        own = words(i, 20, 2000)
        for _ in range(2):
            piece = replaced(rng.choice(items)[1], rng.choice([4, 9, 15, 50])).split()
            low = rng.choice([0, 0, len(piece) // 3])
            own[rng.randrange(len(own)) : 0] = piece[low : low + rng.randrange(3, 60)]
        texts.append((i, " ".join(own)))
    found = decontaminate.contaminations(docs_of(spark, texts), spark.createDataFrame(items, ITEM)).collect()
    want = slow_rows(texts, items)
    assert sorted(tuple(r) for r in found) == want and len(want) > 20


def test_all_stretches_of_a_long_item(spark):
    item = words(1, 200, 50_000)
    middle = words(2, 120, 50_000)
    docs = docs_of(spark, [(1, " ".join([*words(3, 10, 50_000), *item[:40], *middle, *item[160:], "end"]))])
    found = decontaminate.contaminations(docs, spark.createDataFrame([(1, " ".join(item))], ITEM)).collect()
    assert [(r.start, r.words, r.item_start, r.equal) for r in found] == [(10, 40, 0, 40), (170, 40, 160, 40)]


def test_a_row_without_id_and_text_stays(spark):
    passage = text(9, 40)
    docs = spark.createDataFrame([(42, passage, "en", "a", 1), (None, None, "en", "a", 1), (None, passage, "en", "a", 1), (1, None, "en", "a", 1)], SCHEMA)
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, passage)], ITEM)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("1", None), ("None", None)]


def test_blocks_give_the_same(spark):
    items = spark.createDataFrame([(j, text(500 + j, 30)) for j in range(20)] + [(None, text(505, 30)), (30, None), (31, "")], ITEM)
    docs = docs_of(spark, [(j, f"{text(j)} {text(500 + j, 30)}") for j in range(20)])
    one = decontaminate.contaminations(docs, items).collect()
    many = decontaminate.contaminations(docs, items, block_bytes=500).collect()
    assert sorted(map(str, one)) == sorted(map(str, many)) and len(one) == 21


def test_drop_and_odd_rows(spark):
    docs = with_clashes(odd_docs(spark))
    items = spark.createDataFrame([(1, text(4)), (2, text(1))], ITEM)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 1, 2, 3, 6, 6, 7, 8, 9]
    none = spark.createDataFrame([], ITEM)
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    assert decontaminate.contaminations(no_docs(spark), items).collect() == []
