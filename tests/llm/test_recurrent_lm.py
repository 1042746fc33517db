import cProfile
import pstats
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheaf.llm import recurrent_lm as lm
from sheaf.llm.recurrent import Columns, backward, forward, forward_words, traced, word_table
from sheaf.llm.text import doc_hash
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, spaced


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    inputs, state, weights = rng.normal(size=(4, 3, 15)), np.zeros((3, 5)), rng.normal(size=(5, 15))
    factors = rng.normal(size=(4, 3, 5))
    loss = lambda x, w: float((forward(x.astype(np.float64), state, w) * factors).sum())
    _, trace = traced(inputs, state, weights)
    into, recur = backward(factors, trace, weights)
    for array, gradient in ((inputs, into), (weights, recur)):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(8)]:
            step = np.zeros_like(array)
            step[at] = 1e-2
            pair = (inputs + step, weights) if array is inputs else (inputs, weights + step)
            less = (inputs - step, weights) if array is inputs else (inputs, weights - step)
            assert (loss(*pair) - loss(*less)) / 2e-2 == pytest.approx(gradient[at], abs=2e-2, rel=2e-2)


def small_vocabulary():
    hashes = np.array([5, 9, 1, 12, 30], dtype=np.uint64)
    return lm.build_vocabulary(hashes, np.array([7, 3, 4, 2, 1]), 20, 8, head_words=4, classes=2)


def random_weights(vocabulary):
    rng = np.random.default_rng(0)
    return {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in lm.new_weights(vocabulary).items()}


def test_the_factored_softmax_is_a_distribution():
    vocabulary = small_vocabulary()
    w = random_weights(vocabulary)
    states = np.random.default_rng(2).normal(size=(3, lm.WIDTH)).astype(np.float32)
    total = sum(np.exp(lm.log_likelihoods(states, np.full(3, k), w, vocabulary.bounds)) for k in range(vocabulary.size + 1))
    assert total == pytest.approx(np.ones(3), abs=1e-5)


def test_windows_batches_and_order_do_not_change_a_score(monkeypatch):
    vocabulary = small_vocabulary()
    w = random_weights(vocabulary)
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, vocabulary.size + 1, n), vocabulary.end) for n in (0, 1, 40, 100, 33, 31, 32)]
    together = lm.score_sequences(texts, w, vocabulary)
    for window in (1, 5):
        monkeypatch.setattr(lm, "WINDOW", window)
        assert [lm.score_sequences([t], w, vocabulary)[0] for t in texts] == pytest.approx(together, abs=1e-3)
    text, state, total = texts[4], np.zeros((1, lm.WIDTH), dtype=np.float32), 0.0
    projected = w["embed"] @ w["into"] + w["into_bias"]
    for before, token in zip([vocabulary.end, *text], text, strict=False):
        state = forward(projected[[[before]]], state, w["recur"])[0]
        total += lm.log_likelihoods(state, np.array([token]), w, vocabulary.bounds)[0]
    assert total == pytest.approx(together[4], abs=1e-3)


def test_frequent_words_are_bounded(spark):
    counts = spark.createDataFrame([(i, 1 + 1000 // (i + 1)) for i in range(500)], "word long, times long")
    found = lm.corpus_vocabulary(counts, frequent_words=50, head_words=10)
    assert 10 <= len(found.hashes) <= 51 and found.size == 10
    assert found.tokens == sum(1 + 1000 // (i + 1) for i in range(500)) and found.types == 500


def corpus(n=300):
    """Texts that repeat one of two cycles of words: what comes next depends on what came before."""
    cycles = ["a b c d e f g h", "h f d b g e c a"]
    return [(i, " ".join((cycles[i % 2] + " ") * 6) + f" rare{i} rare{i} A", "en", "a", 0) for i in range(n)]


def check_base(got, rows):
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows}
    counts = Counter(t for r in rows if r[0] is not None and not held[r[0]] for t in [*spaced(r[1]), None])
    total, types = sum(counts.values()), len(counts)
    by_id = {r.doc_id: r for r in got}
    for i, value, *_ in rows:
        if i is None or sum(r[0] == i for r in rows) > 1 and len({r[1] for r in rows if r[0] == i}) > 1:
            continue
        tokens = [*spaced(value), None]
        r = by_id[i]
        want = sum(log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in tokens)
        assert isclose(r.base_score, want, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in counts for t in tokens), total)


@pytest.mark.parametrize("frequent", [6, 1 << 18])
def test_scores(spark, monkeypatch, frequent):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(lm.corpus_vocabulary, "__defaults__", (frequent, 4096))
    got = lm.lm_scores(docs, doc_hash(F.col("doc_id"), 5) != 1).collect()
    assert len(got) == len(rows)
    check_base(got, rows)
    # The order of words is learned: far better than counts alone, also where it was not seen.
    if frequent > 6:
        held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 1]
        assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_odd_rows(spark):
    from tests.llm.corpora import odd_rows, with_clashes

    docs = with_clashes(odd_docs(spark).where("doc_id IS NULL OR doc_id != 7"))
    got = lm.lm_scores(docs, doc_hash(F.col("doc_id"), 5) != 1).collect()
    assert len(got) == docs.count()
    check_base(got, [r for r in odd_rows() if r[0] != 7])
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert lm.lm_scores(no_docs(spark), F.lit(True)).collect() == []
    untrained = lm.lm_scores(docs, F.lit(False)).collect()
    assert all(r.base_score == pytest.approx(0) and r.n_known == 0 and r.train_tokens == 0 for r in untrained)


def test_every_training_text_is_learned_from(spark):
    common = " ".join(f"w{k % 40}" for k in range(200))
    rows = spark.range(3000).selectExpr("id AS doc_id", f"concat('own', id, ' {common}') AS text").repartition(4)
    vocabulary = lm.corpus_vocabulary(lm.token_counts(rows))
    assert vocabulary.tokens == 3000 * 202 and vocabulary.size == 3041
    trained = lm.train(rows, vocabulary)
    # A word's vector moves where its text is learned from, unless in the first step, which has only zeros behind it.
    moved = (trained["embed"] != lm.new_weights(vocabulary)["embed"]).any(axis=1)
    assert moved[: vocabulary.size].mean() > 0.9


def test_the_layer_by_columns_is_the_plain_one():
    rng = np.random.default_rng(4)
    draw = lambda *shape: rng.normal(size=shape).astype(np.float32)
    inputs, into, bias, weights = draw(5, 7, 3), draw(3, 12), draw(12), draw(4, 12)
    state, errors = np.zeros((7, 4), dtype=np.float32), draw(5, 7, 4)
    states, trace = traced(inputs @ into + bias, state, weights)
    by_column, kept = Columns.traced(Columns.projected(inputs, into, bias), state.T, weights)
    assert np.allclose(by_column.transpose(0, 2, 1), states, atol=1e-5)
    assert np.allclose(Columns.traced(Columns.projected(inputs, into, bias), state.T, weights, keep=False)[0], by_column)
    for got, want in zip(Columns.backward(errors.transpose(0, 2, 1), kept, weights), backward(errors, trace, weights), strict=True):
        assert np.allclose(got.transpose(0, 2, 1) if got.ndim == 3 else got, want, atol=1e-4)


def test_gradients_of_the_factored_softmax():
    vocabulary = small_vocabulary()
    w = {k: v.astype(np.float64) for k, v in random_weights(vocabulary).items()}
    rng = np.random.default_rng(5)
    states, targets = rng.normal(size=(1, lm.WIDTH, 9)), np.array([4, 0, 3, -1, 1, 2, 4, 0, 3])

    def loss(states, w):
        return -lm._Softmax(lm._rows(states), targets, w, vocabulary.bounds).log_likelihoods().sum() / 8

    back, *of_weights = lm._Softmax(lm._rows(states), targets, w, vocabulary.bounds).gradients(w)
    assert not back[3].any()
    for array, gradient in ((states, back.T[None]), *zip((w["classes"], w["words"]), of_weights, strict=True)):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(12)]:
            step = np.zeros_like(array)
            step[at] = 1e-2
            near = [(states + s, w) if array is states else (states, {k: v + s if v is array else v for k, v in w.items()}) for s in (step, -step)]
            assert (loss(*near[0]) - loss(*near[1])) / 2e-2 == pytest.approx(gradient[at], abs=2e-3)


@pytest.mark.parametrize("scale", [1, 200])
def test_large_logits_stay_finite(scale):
    vocabulary = small_vocabulary()
    w = {k: v * np.float32(scale) for k, v in random_weights(vocabulary).items()}
    states = np.random.default_rng(6).normal(size=(5, lm.WIDTH)).astype(np.float32)
    found = np.array([lm.log_likelihoods(states, np.full(5, k), w, vocabulary.bounds) for k in range(vocabulary.size + 1)])
    assert np.isfinite(found).all() and np.exp(found).sum(axis=0) == pytest.approx(np.ones(5), abs=1e-4)


def test_words_are_looked_up():
    rng = np.random.default_rng(7)
    hashes = np.unique(np.append(rng.integers(2, 1 << 64, 999, dtype=np.uint64), np.array([1, 2, 3, 4, 5], dtype=np.uint64)))
    vocabulary = lm.build_vocabulary(hashes, np.arange(len(hashes)) + 1, 10**6, 2000, head_words=100)
    asked = np.concatenate([hashes, hashes + np.uint64(1), np.array([0, 6, (1 << 64) - 1], dtype=np.uint64)])
    place, number = vocabulary.look_up(asked)
    at = {int(h): i for i, h in enumerate(hashes)}
    assert place.tolist() == [at.get(int(h), -1) for h in asked]
    assert number.tolist() == [vocabulary.head[at[int(h)]] if int(h) in at else vocabulary.size for h in asked]


def test_a_step_of_training_takes_few_calls():
    """Elementwise work is done for all classes at once: calls per step don't add up over classes (1,900 when they did)."""
    rng = np.random.default_rng(8)
    hashes = np.unique(np.append(rng.integers(2, 1 << 64, 20_000, dtype=np.uint64), np.uint64(1)))
    counts = (1e7 / (1 + rng.permutation(len(hashes)))).astype(np.int64)
    vocabulary = lm.build_vocabulary(hashes, counts, int(counts.sum()), len(hashes))
    texts = [rng.choice(vocabulary.head, 512, p=counts / counts.sum()) for _ in range(lm.SEQUENCES)]
    watched = cProfile.Profile()
    watched.runcall(lm.train_shard, texts, lm.new_weights(vocabulary), vocabulary, 1)
    assert pstats.Stats(watched).total_calls / (512 // lm.WINDOW) < 800


def test_the_layer_by_words_is_the_plain_one():
    rng = np.random.default_rng(9)
    draw = lambda *shape: rng.normal(size=shape).astype(np.float32)
    embed, into, bias, weights, state = draw(11, 3), draw(3, 12), draw(12), draw(4, 12), draw(7, 4)
    words = rng.integers(0, 11, (5, 7))
    found = forward_words(words, word_table(embed, into, bias), state, weights)
    assert np.allclose(found[:, :, :4], forward(embed[words] @ into + bias, state, weights), atol=1e-5) and (found[:, :, 4] == 1).all()


def test_texts_of_all_batches_are_scored_side_by_side(monkeypatch):
    """A task's texts are scored together (one batch at a time before, so that few sequences went side by side)."""
    texts = [" ".join(f"w{k % (3 + i % 7)}" for k in range(i)) for i in range(60)]
    hashes = np.unique(np.concatenate([t for _, t, _ in lm._token_hashes([t.encode() for t in texts])]))
    vocabulary = lm.build_vocabulary(hashes[::2], np.arange(len(hashes[::2])) + 1, 500, 20, head_words=4, classes=2)
    weights, calls, scored = random_weights(vocabulary), [], lm.score_sequences

    def found(size):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(range(i, min(60, i + size))), pa.array([t.encode() for t in texts[i : i + size]])], names=["doc_id", "text"])
            for i in range(0, 60, size)
        ]
        rows = pa.Table.from_batches(lm._looked_up(iter(batches), vocabulary, weights)).to_pandas()
        return rows.sort_values(["doc_id", "word", "n_tokens"]).reset_index(drop=True)

    monkeypatch.setattr(lm, "score_sequences", lambda sequences, *rest: calls.append(len(sequences)) or scored(sequences, *rest))
    together, apart = found(60), found(7)
    assert calls == [60, 60]
    assert (together.drop(columns="model") == apart.drop(columns="model")).equals(together.drop(columns="model").notna())
    assert np.allclose(together["model"], apart["model"], atol=1e-3, equal_nan=True)
    monkeypatch.setattr(lm, "POOLED", 100)
    bounded = found(7)
    assert sum(calls) == 180 and max(calls[2:]) < 20 and np.allclose(together["model"], bounded["model"], atol=1e-3, equal_nan=True)
