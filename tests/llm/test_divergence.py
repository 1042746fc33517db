import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import divergence
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, odd_rows, text, with_clashes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(value):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value or "")


def brute_force(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, value, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(lowered(value))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= min_docs) for lang in {g[0] for g in groups}}

    def shares(lang, held):
        total = sum(held[t] for t in kept[lang])
        return {t: 1 + 1_000_000_000 * (held[t] + 2) // (total + 2 * len(kept[lang])) for t in kept[lang]}

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    share = {g: shares(g[0], counts[g]) for g in groups}
    found = []
    for lang, source in groups:
        p = share[lang, source]
        pairs = [(other, sum(apart(p[t], share[lang, other][t]) for t in kept[lang])) for same, other in groups if same == lang and other != source]
        whole = shares(lang, sum((counts[g] for g in groups if g[0] == lang), Counter()))
        terms = [(t, apart(p[t], whole[t])) for t in kept[lang] if counts[lang, source][t] and p[t] > whole[t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
            found += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(items, 1)]
    return Counter(found)


def audited(spark, rows, **options):
    found = divergence.source_divergences(spark.createDataFrame(rows, SCHEMA), **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return Counter(tuple(r) for r in found.collect())


def rows_of(n):
    sources = ["hot"] * 6 + [f"s{i}" for i in range(9)] + [None, "é"]
    rows = []
    for i in range(n):
        words = text(i, 5 + i % 40, 30 + i % 11).replace("w", "wort", 1)
        words = re.sub(r"\d", lambda m: "abcdefghij"[int(m.group())], words)
        rows.append((i, f"{words.title()}, Äpfel-äpfel!", ("en", "en", "de", None)[i % 4], sources[i * 7 % len(sources)], 0))
    return rows


@pytest.mark.parametrize("blocks", [{}, {"group_block": 2, "term_block": 8}, {"group_block": 1, "term_block": 1000}])
def test_against_brute_force(spark, blocks):
    rows = rows_of(220)
    found = audited(spark, rows, **blocks)
    assert found == brute_force(rows, 10, 10)
    assert {r[2] for r in found} == {"pair", "term"}


def test_languages_without_terms_and_odd_rows(spark):
    rows = odd_rows()
    assert audited(spark, rows) == brute_force(rows, 10, 10)
    assert audited(spark, rows, min_docs=1, top_terms=3) == brute_force(rows, 1, 3)
    docs = with_clashes(odd_docs(spark)).selectExpr("*", "1 AS term", "2 AS `block`", "3 AS n", "4 AS value")
    assert Counter(tuple(r) for r in divergence.source_divergences(docs).collect()) == audited(spark, rows)
    assert divergence.source_divergences(no_docs(spark)).collect() == []


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([1, 7, 10**15 - 1, 3_333_333_333_333_333], dtype=np.int64)
    totals = np.array([3, 7, 10**15, 9_000_000_000_000_001], dtype=np.int64)
    assert divergence.scaled(counts, totals).tolist() == [1 + 10**9 * a // b for a, b in zip(counts.tolist(), totals.tolist(), strict=True)]
