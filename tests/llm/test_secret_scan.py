import base64
import hashlib
import math
import random
import re
from collections import Counter

import pytest

from sheaf.llm import secret_scan
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, text, with_clashes

PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute_force(value):
    """Base spans of one text as the contract puts them: all matches, then those that are long enough."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(value or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [name for _, _, name in sorted(found)]


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in secret_scan.scan_secrets(docs).collect()}


def random_texts(seed, n):
    rng = random.Random(seed)
    parts = ["password", "PassWord", "passwd", "secret", "toKen", "api_key", "APIKEY", "apikey", "AKIA", "AKIAAKIA", '"', "'", " ", "  ", ":", "=", "é", "日", "\n"]
    parts += ["hunter2", "x.y-z=", "0123456789abcdef", "deadbeefdeadbeefdeadbeef", "ABCDEF0123456789", "f" * 30, "ſecret", "toKen"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_base_spans_against_plain_patterns(spark):
    texts = random_texts(1, 3000)
    found = scanned(spark, texts)
    hits = 0
    for i, value in enumerate(texts):
        want = brute_force(value)
        hits += len(want)
        assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        spans = found[i].spans.split(",") if found[i].spans else []
        assert [s for s in spans if not s.startswith("entropy")] == want
        assert len(spans) == len(want) + found[i].n_entropy
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), secret_scan.KINDS.index(s.split(":")[0])))
    assert hits > 1000


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


@pytest.mark.parametrize("window", [2, 5, 24])
def test_entropies_against_counting_each_window(window):
    rng = random.Random(window)
    pieces = [bytes(rng.choice(b"abcdefgh01") for _ in range(rng.choice([0, 1, 23, 24, 25, 200]))) for _ in range(60)]
    found = secret_scan.window_entropies(pieces, window)
    for piece, got in zip(pieces, found, strict=True):
        assert got.tolist() == pytest.approx([entropy(piece[i : i + window]) for i in range(len(piece) - window + 1)])
    assert secret_scan.window_entropies([]) == []


def random_key(seed, size=30):
    return base64.b64encode(random.Random(seed).randbytes(size)).decode()


def test_random_strings_are_found_and_plain_ones_are_not(spark):
    rng = random.Random(9)
    keys = [random_key(i, 45) for i in range(50)]
    urlsafe = [base64.urlsafe_b64encode(rng.randbytes(33)).decode() for _ in range(50)]
    upper = [rng.randbytes(20).hex().upper() for _ in range(50)]
    plain = [
        text(3),
        "550e8400-e29b-41d4-a716-446655440000",
        "abcdefghijklmnopqrstuvwxyz0123456789",
        "Donaudampfschifffahrtsgesellschaftskapitaen",
        "the_quick_brown_fox_jumps_over_lazy_dogs",
        "/usr/share/dictionary_files/english/words",
        "abc123XYZ" * 6,
        "x" * 80,
        f"sha256-{random_key(99, 32)}",
        "",
        None,
    ]
    found = scanned(spark, [f"Words é {k} and words" for k in keys + urlsafe + upper] + plain)
    hits = [found[i].n_entropy > 0 for i in range(150)]
    assert sum(hits[:50]) >= 49 and sum(hits[50:100]) >= 48 and sum(hits[100:]) >= 48
    assert [i for i in range(150, 150 + len(plain)) if found[i].spans] == []
    kind, start, end = found[0].spans.split(",")[0].split(":")
    assert kind == "entropy_base64" and int(start) >= 8 and int(end) <= 8 + len(keys[0])


def test_base_spans_stay_and_are_not_found_twice(spark):
    key = random_key(5)
    value = f'api_key = "{key}" and {"0123456789abcdef" * 2}'
    found = scanned(spark, [value])[0]
    assert found.spans.split(",") == brute_force(value) and found.n_entropy == 0
    assert found.n_hex == 1, "a sample of the allow-list is suppressed for windows alone"


def test_long_candidates_are_searched_whole(spark):
    quiet, key = "Ab1" * 20_000, random_key(11)
    found = scanned(spark, [f"{quiet}{key}{quiet}", f"{text(1, 200_000)} {key}"])
    assert all(r.n_entropy == 1 for r in found.values())
    start, end = map(int, found[0].spans.split(":")[1:])
    assert len(quiet) - 24 < start < len(quiet) + len(key) - 24 and end < len(quiet) + len(key) + 24


def test_spans_that_touch_known_ones_are_left_out():
    known = [(5, 9, 0), (20, 50, 1), (22, 24, 2)]
    spans = [(0, 5), (8, 10), (9, 20), (30, 31), (50, 60), (49, 51)]
    assert secret_scan._apart(spans, known) == [(0, 5), (9, 20), (50, 60)]


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark)).selectExpr("*", "1 AS spans", "2 AS n_hex")
    rows = secret_scan.scan_secrets(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secret_scan.scan_secrets(no_docs(spark)).collect() == []
