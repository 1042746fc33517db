import random
from itertools import combinations

from sheaf.llm import line_dedup
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, text, with_clashes


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], SCHEMA)


def cleaned(spark, texts, **options):
    return {r.doc_id: r.text for r in line_dedup.deduplicate_lines(docs_of(spark, texts), **options).collect()}


def test_longest_increasing_against_all_subsequences():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.randrange(8) for _ in range(rng.randrange(9))]
        found = line_dedup.longest_increasing(values)
        chosen = [values[i] for i in found]
        assert chosen == sorted(set(chosen)) and found == sorted(found)
        longest = max((n for n in range(len(values) + 1) for c in combinations(values, n) if list(c) == sorted(set(c))), default=0)
        assert len(found) == longest


def test_a_shared_passage_leaves_the_later_document(spark):
    passage = "\n".join(text(i, 15) for i in (50, 51))
    texts = [(3, f"{text(1)}\n{passage}\n{text(2)}"), (1, f"{text(3)}\n{text(4)}\n{passage}"), (2, text(5))]
    got = cleaned(spark, texts)
    assert got[1] == texts[1][1] and got[2] == texts[2][1]
    assert got[3] == f"{text(1)}\n{text(2)}"


def test_moved_blocks_go_too_and_short_ones_stay(spark):
    a, b, short = text(60, 25), text(61, 25), "only a few words"
    got = cleaned(spark, [(1, f"{a}\nx\ny\nz\nu\n{b}\n{short}"), (2, f"{b}\np q\nr\ns\nt\n{a}\nv\nw\nq\no\n{short}")])
    assert got[2] == f"p q\nr\ns\nt\nv\nw\nq\no\n{short}"


def test_of_many_documents_the_first_keeps_a_frequent_line(spark):
    line = text(70, 30)
    got = cleaned(spark, [(i, f"{text(100 + i)}\n{line}") for i in range(1, 60)])
    assert [i for i in got if line in got[i]] == [1]
    assert all(got[i] == text(100 + i) for i in range(2, 60))


def brute_force(texts, min_words):
    """Lines of later documents whose n-th occurrence an earlier document has too, if each alone is long enough."""
    first = {}
    counted = []
    for i, value in sorted(texts):
        seen = {}
        for pos, line in enumerate(value.split("\n")):
            nth = seen[line] = seen.get(line, 0) + 1
            counted.append((i, pos, line, nth))
            first.setdefault((line, nth), i)
    gone = {(i, pos) for i, pos, line, nth in counted if first[line, nth] < i and len(line.split()) >= min_words}
    return {i: "\n".join(x for p, x in enumerate(value.split("\n")) if (i, p) not in gone) for i, value in texts}


def test_long_lines_against_brute_force(spark):
    rng = random.Random(5)
    lines = [text(200 + i, 20) for i in range(40)]
    texts = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))) for i in range(50)]
    assert cleaned(spark, texts) == brute_force(texts, 20)


def all_pairs(texts, min_words=20):
    """Lines that aligning each document with every earlier one takes away, and those of common runs of lines."""
    lines = {i: [x for x in t.split("\n") if x.split()] for i, t in texts}
    gone = {i: set() for i in lines}
    for i, own in lines.items():
        for j, other in lines.items():
            if j < i:
                place = {line: p for p, line in enumerate(other)}
                matches = [(p, place[line], len(line.split())) for p, line in enumerate(own) if line in place]
                gone[i] |= set(line_dedup.common_blocks(matches, min_words))
                for p in range(len(own)):
                    for q in (q for q in range(len(other)) if other[q] == own[p]):
                        n = 0
                        while p + n < len(own) and q + n < len(other) and own[p + n] == other[q + n]:
                            n += 1
                        if sum(len(x.split()) for x in own[p : p + n]) >= min_words:
                            gone[i] |= set(range(p, p + n))
    return {i: "\n".join(x for p, x in enumerate(own) if p not in gone[i]) for i, own in lines.items()}


def test_a_passage_whose_lines_stand_alone_elsewhere(spark):
    block = [f"{text(300 + k, 8)}" for k in range(6)]
    singles = [(i, f"{text(400 + i, 9)}\n{block[i]}\n{text(500 + i, 9)}") for i in range(6)]
    between = [(11 + i, f"{text(600 + i, 9)}\n{block[i]}") for i in range(6)]
    passage = "\n".join(block)
    got = cleaned(spark, [*singles, (10, f"{text(7, 30)}\n{passage}"), *between, (17, f"{passage}\n{text(8, 30)}")])
    assert got[17] == text(8, 30) and got[10] == f"{text(7, 30)}\n{passage}"
    assert all(got[i] == t for i, t in singles + between)


def test_a_passage_of_very_frequent_lines(spark):
    block = [text(300 + k, 8) for k in range(4)]
    singles = [(i, f"{text(1000 + i, 9)}\n{block[i % 4]}") for i in range(200)]
    passage = "\n".join(block)
    got = cleaned(spark, [*singles, (300, passage), (301, f"{text(1, 5)}\n\n{passage}"), (302, f"{passage}\n{passage}")])
    assert got[300] == passage and got[301] == f"{text(1, 5)}\n"
    assert got[302] == passage, "the second time is no copy of an earlier document's"


def test_rare_lines_against_all_pairs(spark):
    rng = random.Random(8)
    blocks = [[text(3000 + 20 * b + k, rng.randrange(4, 12)) for k in range(rng.randrange(2, 7))] for b in range(30)]
    texts, uses = [], [0] * 30
    for i in range(60):
        lines = [text(10_000 + i, 6)]
        for b in rng.sample(range(30), 3):
            uses[b] += 1
            if uses[b] <= line_dedup.RARE:
                part = [x for x in blocks[b] if rng.random() < 0.85]
                lines += [*part, text(20_000 + 40 * i + b, 5)]
        texts.append((i, "\n".join(lines)))
    got = cleaned(spark, texts)
    want = all_pairs(texts)
    assert got == want and sum(got[i] != t for i, t in texts) > 20


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark))
    got = line_dedup.deduplicate_lines(docs, removed="away")
    assert got.columns == [*docs.columns, "away"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert [(r.text, r.away) for r in rows if r.doc_id == 5] == [("", 1)]
    assert [r.text for r in rows if r.doc_id == 4] == [text(4)] * 2
    assert all(r.away == 0 for r in rows if r.doc_id != 5)
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert line_dedup.deduplicate_lines(no_docs(spark)).collect() == []
