"""Toxicity, quality and language: held-out accuracy on generated texts, whole texts, and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheaf.llm import language_id, quality, toxicity
from sheaf.llm.samples import labelled_rows
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, text, with_clashes

LABELS = "doc_id long, quality int, toxic int"
ODD_LABELS = [(1, 1, 0), (4, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (99, 1, 1), (6, 0, 1), (2, 1, 0)]


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def toxic_corpus(n=900):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        words = text(i, rng.randrange(15, 90)).split()
        toxic = i % 3 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilefoo", "vilebar", "vilebaz", "grimq"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def toxic_weights():
    rows = [r for r in toxic_corpus() if remainder(r[0], 4) != 2]
    return toxicity.train([r[1].encode() for r in rows], np.array([r[2] for r in rows], dtype=float), looks=4000)


def test_toxicity_held_out(toxic_weights):
    rows = [r for r in toxic_corpus() if remainder(r[0], 4) == 2]
    found = toxicity.classify([r[1].encode() for r in rows], toxic_weights)
    right = [(s >= toxicity.THRESHOLD) == bool(y) for s, (_, _, y) in zip(found, rows, strict=True)]
    assert sum(right) >= 0.95 * len(right)


def test_toxicity_looks_at_every_window(toxic_weights):
    clean = text(1, 3000)
    long = [clean, f"{clean} vilefoo {text(2, 40)}", f"vilefoo {clean}", f"{clean} vilefoo"]
    found = toxicity.classify([t.encode() for t in long], toxic_weights)
    assert all(found[1:] >= toxicity.THRESHOLD) and found[0] < found[1:].min()


def test_toxicity_of_a_cut_text_is_that_of_its_parts(toxic_weights, monkeypatch):
    texts = [text(i, 400).encode() for i in range(4)] + [b"", b"!?"]
    together = toxicity.classify(texts, toxic_weights)
    alone = [toxicity.classify([t], toxic_weights)[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-5)


def test_toxicity_gradients():
    texts = [b"a b c d", b"b c vile d e", b""]
    w = {k: v.astype(np.float64) if k != "known" else v for k, v in toxicity.new_weights(np.zeros(0, np.uint64)).items()}
    changed = {k: v.copy() for k, v in w.items()}

    class Recorder:
        def apply(self, gradients):
            self.gradients = gradients

        def apply_rows(self, *_):
            pass

    recorder = Recorder()
    words = toxicity.Words(texts, w["known"])
    toxicity._learn(words, np.array([0.0, 1.0, 0.0]), changed, recorder)

    def loss(v):
        vectors, _ = toxicity._vectors(words, v)
        ids, owner = words.windows()
        z = toxicity.window_logits(words, ids, v, tuple(toxicity._projected(vectors, v, way) for way in "fb"))
        p = 1 / (1 + np.exp(-z))
        return float(-(np.log(1 - p[owner == 0]).sum() + np.log(p[owner == 1]).sum()) / 2)

    rng = np.random.default_rng(4)
    for name in ("rec_f", "rec_b", "key", "query", "out", "in_f", "bias_b"):
        at = tuple(rng.integers(0, n) for n in w[name].shape)
        up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(recorder.gradients[name][at], abs=2e-3)


def test_toxicity_is_learned_from_whole_long_texts(spark):
    # What marks a text stands in a few of its over 64 windows, anywhere.
    rows = []
    for i in range(240):
        words = text(i, 900 + i % 300).split()
        if i % 2:
            at = (i * 211) % len(words)
            words[at:at] = ["vilefoo", "vilebar", "grimq"] * 4
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, None, i % 2) for i, _ in rows], LABELS)
    held = [r for r in toxicity.toxicity_scores(docs, labels).collect() if r.held_out]
    assert sum((r.score >= toxicity.THRESHOLD) == bool(r.doc_id % 2) for r in held) >= 0.95 * len(held) > 0


def test_toxicity_goes_back_through_the_highest_windows(toxic_weights):
    clean = text(3, 2000)
    words = toxicity.Words([f"{clean} vilefoo".encode(), b"", clean.encode(), b"few words"], toxic_weights["known"])
    ids, owner = words.windows()
    vectors, _ = toxicity._vectors(words, toxic_weights)
    places = toxicity._highest(words, ids, owner, vectors, toxic_weights)
    assert np.bincount(owner[places]).tolist() == [toxicity.LEARNED, 0, toxicity.LEARNED, 1]
    logits = toxicity.window_logits(words, ids, toxic_weights, tuple(toxicity._projected(vectors, toxic_weights, way) for way in "fb"))
    for k in (0, 2):
        left = np.setdiff1d(np.flatnonzero(owner == k), places)
        assert logits[places[owner[places] == k]].min() >= logits[left].max() - 1e-5


def test_toxicity_rows(spark, toxic_weights):
    docs = with_clashes(odd_docs(spark))
    labels = spark.createDataFrame(ODD_LABELS, LABELS)
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    kept = toxicity.drop_toxic(docs, toxic_weights)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.toxicity_scores(no_docs(spark), labels).collect() == []
    assert toxicity.toxicity_scores(docs, spark.createDataFrame([], LABELS)).count() == docs.count()


def test_toxicity_gets_texts_in_small_batches(spark, toxic_weights):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["size"])

    docs = spark.range(2000).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 5000).alias("text"))
    for scored in (toxicity.score, toxicity.drop_toxic):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        scored(docs, toxic_weights)
        found = [r.size for r in docs.select("text").mapInArrow(sizes, "size long").collect()]
        assert len(found) > 3 and max(found) < 6_000_000


def quality_corpus(n=400):
    rows = []
    for i in range(n):
        good = i % 4 > 0
        value = text(i, 30 + i % 60)
        rows.append((i, value if good else " | ".join(value.upper().split()) + "!!", int(good)))
    return rows


def test_quality_held_out(spark):
    rows = quality_corpus()
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y, None) for i, _, y in rows], LABELS)
    truth = {i: y for i, _, y in rows}
    got = quality.quality_scores(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if remainder(i, 3) == 1}
    assert sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in held) >= 0.97 * len(held)


def test_quality_of_a_cut_text(monkeypatch):
    weights = np.random.default_rng(0).normal(size=1 << quality.BUCKET_BITS).astype(np.float32)
    texts = [text(i, 700).encode() for i in range(3)] + [b"", b" "]
    whole = quality.classify(texts, weights, 0.1)
    monkeypatch.setattr(quality, "CHUNK_BYTES", 400)
    assert quality.classify(texts, weights, 0.1) == pytest.approx(whole, abs=1e-9)


def test_quality_learns_from_long_texts_as_bags(monkeypatch):
    texts = [text(i, 900).encode() for i in range(4)]
    whole = [quality.bag(t) for t in texts]
    monkeypatch.setattr(quality, "CHUNK_BYTES", 500)
    monkeypatch.setattr(quality, "LONG_BYTES", len(texts[1]))
    for t, (found, times) in zip(texts, whole, strict=True):
        assert all((a == b).all() for a, b in zip(quality.bag(t), (found, times), strict=True))
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array([1, 0, 1, 0], pa.int32()), pa.array(texts, pa.binary())], names=["doc_id", "label", "text"])
    for row, t, (found, times) in zip(next(quality._shortened([batch])).to_pylist(), texts, whole, strict=True):
        if len(t) <= len(texts[1]):
            assert row["text"] == t and row["found"] is None
        else:
            assert row["text"] is None and (np.frombuffer(row["found"], np.int32) == found).all() and (np.frombuffer(row["times"], np.int64) == times).all()


def test_quality_is_learned_from_whole_texts(spark):
    same = text(1, 60) + " "
    rows = [(i, same * 25 + ("fine " if i % 2 else "junk ") * 300 + same * 25) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in rows], LABELS)
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in quality.quality_scores(docs, labels).collect())


def test_quality_rows(spark):
    docs = with_clashes(odd_docs(spark))
    labels = spark.createDataFrame(ODD_LABELS, LABELS)
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(no_docs(spark), labels).collect() == []
    untaught = quality.quality_scores(docs, spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in untaught} == {0.5}


def test_the_sample_is_bounded_and_takes_the_largest_label(spark):
    docs = spark.createDataFrame([(i, "t", "en", "a", 0) for i in range(2000)], SCHEMA)
    labels = spark.createDataFrame([(i, 0, 0) for i in range(2000)] + [(i, 1, 0) for i in range(0, 2000, 2)], LABELS)
    rows = labelled_rows(docs, labels, "quality", F.lit(True), 200).collect()
    assert 120 < len(rows) < 300 and all(r.label == (r.doc_id % 2 == 0) for r in rows)
    assert labelled_rows(docs, labels, "quality", F.lit(True), 5000).count() == 2000


SPEECH = {"xa": "ka to mi ru sen lo", "yb": "grü schn ächt ung bar", "zc": "éta oui çal mont àre"}


def speech_corpus(n=360):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = sorted(SPEECH)[i % 3]
        syllables = SPEECH[lang].split()
        rows.append((i, " ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(rng.randrange(5, 200))), lang, "a", 0))
    return rows


def test_copies_of_one_labelled_id_are_one_row(spark):
    docs = spark.range(10_000).selectExpr("7L AS doc_id", "concat('text ', id % 3) AS text").unionByName(spark.createDataFrame([(8, "other")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    rows = labelled_rows(docs, labels, "quality", F.lit(True), 100).collect()
    assert sorted((r.doc_id, r.label, r.text) for r in rows) == [(7, 1, "text 0"), (8, 0, "other")]


def test_languages_held_out(spark):
    rows = speech_corpus()
    got = language_id.languages(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if remainder(i, 4) == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_languages_are_learned_from_all_windows(spark):
    # The first 8 KB of all texts are the same; only what follows tells the languages apart.
    rows = [(i, f"{'same old words ' * 550}{t}", lang, "a", 0) for i, t, lang, *_ in speech_corpus(240)]
    held = [r for r in language_id.languages(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in held) >= 0.9 * len(held) > 0


def test_windows_cover_a_text_and_batches_do_not_matter():
    for size in (0, 1, 3, 4, 5, 255, 256, 257, 508, 509, 2000):
        value = bytes(1 + i % 250 for i in range(size))
        windows = language_id.window_rows(value)
        for k in range(size - 4):
            assert any(value[k : k + 5] in bytes(w) for w in windows)
        assert (len(windows) - 1) * 252 < max(1, size)
    texts = [r[1].encode() for r in speech_corpus(30)]
    net = language_id.train(texts, np.array([i % 3 for i in range(30)]), sorted(SPEECH))
    names, odds = language_id.identify(texts, net)
    for t, name, odd in zip(texts, names, odds, strict=True):
        assert language_id.identify([t], net)[0] == [name]
        assert language_id.identify([t], net)[1][0] == pytest.approx(odd, abs=1e-5)


def test_letters():
    assert not any(map(language_id.has_letter, (b"", b"123 !?", "٣ ½ _".encode(), b"\xff\xfe")))
    assert all(map(language_id.has_letter, (b"a", "日".encode(), b"1" * 9000 + "é".encode(), b"1" * 4095 + "é".encode())))


def test_language_rows(spark):
    docs = with_clashes(odd_docs(spark))
    got = language_id.languages(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 9)} == {"und"}
    assert "und" not in {r.lang_pred for r in got if r.doc_id in (4, 7, 8)}
    assert language_id.languages(no_docs(spark)).collect() == []
    assert {r.lang_pred for r in language_id.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
