"""Toxicity: a bidirectional gated recurrent network with attention over the words of overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.batches import bound_batches
from sheaf.llm.recurrent import Adagrad, backward, forward, traced
from sheaf.llm.samples import labelled_rows, sigmoid, text_parts
from sheaf.llm.text import ALNUM, doc_hash, joined, span_hashes, text_bytes, unused_name, word_bounds

#: Fitted on the whole texts of about so many toxic and so many other rows at most.
TRAIN_ROWS = 1000, 3000
#: Each look at a text scores all its windows; errors go back through so many of them, those with the highest scores.
LEARNED = 64
#: Texts that training looks at, the same one again after all others, and so many times at most.
LOOKS = 14_000
PASSES = 10
#: Words in so many training texts have a vector of their own; rarer ones share one.
KNOWN_IN = 6
THRESHOLD = 0.3
#: A window has so many words; the next starts this many words later.
WINDOW = 24
STRIDE = 12
WIDTH = 8
WORD_DEPTH = 8
GRAM_BITS, GRAM_DEPTH, GRAM = 16, 8, 4
BATCH = 16
#: How much more the text's logit follows its highest windows than a softmax.
SHARPNESS = 2
RATE = 0.03
SEED = 3
#: Bytes of text scored at once.
CHUNK = 1 << 18

Weights = dict[str, np.ndarray]
_CODES = np.random.default_rng(SEED).integers(1, 1 << 31, 256, dtype=np.uint32) | np.uint32(1)


class Words:
    """The words of some texts: each distinct word once, with its row and those of its character n-grams."""

    def __init__(self, texts: list[bytes], known: np.ndarray):
        data, at = joined(texts)
        starts, ends = word_bounds(data, ALNUM)
        hashes = span_hashes(data, starts, ends)
        self.bounds = np.searchsorted(starts, at)
        self.distinct, first, self.ids = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(known, self.distinct)
        self.buckets = np.where(np.append(known, 0)[place] == self.distinct, place + 1, 0)
        starts, lengths = starts[first], ends[first] - starts[first]
        # The distinct words one after the other, with edges between: no n-gram reaches into the next word.
        room = lengths + GRAM - 1
        own = np.cumsum(room) - room + 1
        codes = np.full(int(room.sum()) + GRAM, 7, dtype=np.uint32)
        steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes[np.repeat(own, lengths) + steps] = _CODES[data[np.repeat(starts, lengths) + steps]]
        grams = np.full(len(codes) - GRAM + 1, 11, dtype=np.uint32)
        for k in range(GRAM):
            grams = (grams ^ codes[k : k + len(grams)]) * np.uint32(0x01000193)
        grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        self.gram_counts = np.maximum(lengths - 1, 1)
        self.gram_starts = np.cumsum(self.gram_counts) - self.gram_counts
        steps = np.arange(self.gram_counts.sum()) - np.repeat(self.gram_starts, self.gram_counts)
        self.grams = (grams[np.repeat(own - 1, self.gram_counts) + steps] >> np.uint32(32 - GRAM_BITS)).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all windows, with the number of distinct words where a window has ended, and each one's text."""
        counts = np.diff(self.bounds)
        number = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1), 0)
        owner = np.repeat(np.arange(len(counts)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        places = (self.bounds[owner] + nth * STRIDE)[:, None] + np.arange(WINDOW)
        inside = places < self.bounds[owner + 1][:, None]
        padded = np.append(self.ids, 0)[np.minimum(places, len(self.ids))]
        return np.where(inside, padded, len(self.distinct)), owner


def new_weights(known: np.ndarray) -> Weights:
    rng = np.random.default_rng(SEED)
    depth = WORD_DEPTH + GRAM_DEPTH
    shapes = {
        "words": (len(known) + 1, WORD_DEPTH), "grams": (1 << GRAM_BITS, GRAM_DEPTH), "in_f": (depth, 3 * WIDTH), "in_b": (depth, 3 * WIDTH),
        "bias_f": (3 * WIDTH,), "bias_b": (3 * WIDTH,), "rec_f": (WIDTH, 3 * WIDTH), "rec_b": (WIDTH, 3 * WIDTH),
        "key": (2 * WIDTH, WIDTH), "query": (WIDTH,), "out": (2 * WIDTH,), "out_bias": (1,),
    }
    scale = {"words": 0.1, "grams": 0.2, "bias_f": 0, "bias_b": 0, "out_bias": 0}
    return {k: (rng.normal(0, 1, s) * scale.get(k, 0.4)).astype(np.float32) for k, s in shapes.items()} | {"known": known}


def _vectors(words: Words, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """A vector of each distinct word: its own, and the squashed sum of its n-grams'."""
    grams = np.tanh(np.add.reduceat(w["grams"][words.grams], words.gram_starts, axis=0)) if len(words.grams) else np.zeros((0, GRAM_DEPTH), np.float32)
    return np.concatenate([w["words"][words.buckets], grams], axis=1), grams


def _projected(vectors: np.ndarray, w: Weights, way: str) -> np.ndarray:
    """The input's part of the gates for each distinct word; after them, for no word."""
    return np.concatenate([vectors @ w[f"in_{way}"] + w[f"bias_{way}"], w[f"bias_{way}"][None]])


def _attend(states: np.ndarray, inside: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit of each window, attention weights and keys; states are (steps, windows, width)."""
    keys = np.tanh(states @ w["key"])
    scores = np.where(inside, keys @ w["query"], -1e9)
    odds = np.exp(scores - scores.max(axis=0))
    odds /= odds.sum(axis=0)
    pooled = np.einsum("tn,tnd->nd", odds, states)
    return pooled @ w["out"] + w["out_bias"], odds, keys


def window_logits(words: Words, ids: np.ndarray, w: Weights, projected: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    start = np.zeros((len(ids), WIDTH), dtype=np.float32)
    steps = ids.T
    ahead = forward(projected[0][steps], start, w["rec_f"])
    back = forward(projected[1][steps[::-1]], start, w["rec_b"])[::-1]
    return _attend(np.concatenate([ahead, back], axis=2), steps < len(words.distinct), w)[0]


def classify(texts: list[bytes], w: Weights) -> np.ndarray:
    """The greatest probability among the windows of each whole text; of a text without words, that of an empty window."""
    empty = Words([b""], w["known"])
    none = np.full((1, WINDOW), 0)
    bare = tuple(_projected(np.zeros((0, WORD_DEPTH + GRAM_DEPTH), np.float32), w, way) for way in "fb")
    best = np.full(len(texts), -np.inf)
    lowest = float(window_logits(empty, none, w, bare)[0])
    for owners, parts in text_parts(texts, ALNUM, CHUNK):
        words = Words(parts, w["known"])
        if not len(words.ids):
            continue
        vectors, _ = _vectors(words, w)
        projected = tuple(_projected(vectors, w, way) for way in "fb")
        ids, owner = words.windows()
        for start in range(0, len(ids), 2048):
            part = slice(start, start + 2048)
            np.maximum.at(best, owners[owner[part]], window_logits(words, ids[part], w, projected))
    return sigmoid(np.where(np.isfinite(best), best, lowest))


def train(texts: list[bytes], labels: np.ndarray, looks: int = LOOKS) -> Weights:
    """Adagrad over batches of texts. A text's logit is the mean of its windows', weighted by their softmax."""
    rng = np.random.default_rng(SEED)
    seen = [Words([t], np.zeros(0, dtype=np.uint64)) for t in texts]
    words, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *(x.distinct for x in seen)]), return_counts=True)
    w = new_weights(words[times >= KNOWN_IN])
    # The first number of each vector starts as the log-odds of texts that hold the word or n-gram.
    for name, size in (("words", len(w["known"]) + 1), ("grams", 1 << GRAM_BITS)):
        held = np.full((2, size), 1.0)
        for x, y in zip(seen, labels, strict=True):
            places = np.searchsorted(w["known"], x.distinct[np.isin(x.distinct, w["known"])]) + 1 if name == "words" else np.unique(x.grams)
            held[int(y), places] += 1
        odds = np.log(held[1] / (2 + (labels == 1).sum())) - np.log(held[0] / (2 + (labels == 0).sum()))
        w[name][:, 0] = np.clip(np.where(held.sum(axis=0) >= KNOWN_IN + 2, odds, 0), -4, 4) / 4
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.02, 0.98)
    w["out_bias"][0] = np.log(share / (1 - share))
    optimizer = Adagrad({k: v for k, v in w.items() if k != "known"}, RATE)
    for _ in range(min(PASSES, -(-looks // max(1, len(texts)))) if texts else 0):
        order = rng.permutation(len(texts))
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            _learn(Words([texts[i] for i in batch], w["known"]), labels[batch], w, optimizer)
    return w


def _highest(words: Words, ids: np.ndarray, owner: np.ndarray, vectors: np.ndarray, w: Weights) -> np.ndarray:
    """Places of the ``LEARNED`` windows of each text that score highest; the softmax leaves next to nothing to the others."""
    if np.bincount(owner).max() <= LEARNED:
        return np.arange(len(ids))
    projected = tuple(_projected(vectors, w, way) for way in "fb")
    logits = np.concatenate([window_logits(words, ids[i : i + 2048], w, projected) for i in range(0, len(ids), 2048)])
    order = np.lexsort((-logits, owner))
    nth = np.arange(len(order)) - np.searchsorted(owner, owner)
    return np.sort(order[nth < LEARNED])


def _learn(words: Words, labels: np.ndarray, w: Weights, optimizer: Adagrad) -> None:
    ids, owner = words.windows()
    if not len(ids):
        return
    vectors, grams = _vectors(words, w)
    highest = _highest(words, ids, owner, vectors, w)
    ids, owner = ids[highest], owner[highest]
    steps = ids.T
    inside = steps < len(words.distinct)
    start = np.zeros((len(ids), WIDTH), dtype=np.float32)
    ahead, trace_f = traced(_projected(vectors, w, "f")[steps], start, w["rec_f"])
    back, trace_b = traced(_projected(vectors, w, "b")[steps[::-1]], start, w["rec_b"])
    states = np.concatenate([ahead, back[::-1]], axis=2)
    logits, odds, keys = _attend(states, inside, w)
    # The text's logit from its windows'.
    peak = np.full(len(labels), -np.inf)
    np.maximum.at(peak, owner, logits)
    share = np.exp(SHARPNESS * (logits - peak[owner]))
    share /= np.bincount(owner, share, len(labels))[owner]
    whole = np.bincount(owner, share * logits, len(labels))
    has = np.bincount(owner, minlength=len(labels)) > 0
    error = ((sigmoid(whole) - labels) * has / max(1, has.sum()))[owner] * share
    error = error.astype(np.float32)
    pooled = np.einsum("tn,tnd->nd", odds, states)
    d_pooled = error[:, None] * w["out"]
    d_odds = np.einsum("nd,tnd->tn", d_pooled, states)
    d_scores = odds * (d_odds - (odds * d_odds).sum(axis=0))
    d_keys = d_scores[:, :, None] * w["query"] * (1 - keys * keys)
    d_states = odds[:, :, None] * d_pooled + d_keys @ w["key"].T
    into_f, rec_f = backward(d_states[:, :, :WIDTH], trace_f, w["rec_f"])
    into_b, rec_b = backward(d_states[::-1, :, WIDTH:], trace_b, w["rec_b"])
    gradients = {
        "rec_f": rec_f, "rec_b": rec_b, "out": pooled.T @ error, "out_bias": error.sum(keepdims=True),
        "query": np.einsum("tn,tnd->d", d_scores, keys), "key": np.einsum("tnd,tnk->dk", states, d_keys),
    }
    d_vectors = np.zeros_like(vectors)
    for way, into, at in (("f", into_f, steps), ("b", into_b, steps[::-1])):
        order = np.argsort(at, axis=None, kind="stable")
        found, first = np.unique(at.ravel()[order], return_index=True)
        total = np.zeros((len(words.distinct) + 1, 3 * WIDTH), dtype=np.float32)
        total[found] = np.add.reduceat(into.reshape(-1, 3 * WIDTH)[order], first, axis=0)
        gradients[f"bias_{way}"] = total.sum(axis=0)
        gradients[f"in_{way}"] = vectors.T @ total[:-1]
        d_vectors += total[:-1] @ w[f"in_{way}"].T
    d_grams = d_vectors[:, WORD_DEPTH:] * (1 - grams * grams)
    optimizer.apply(gradients)
    optimizer.apply_rows("words", words.buckets, d_vectors[:, :WORD_DEPTH])
    optimizer.apply_rows("grams", words.grams, np.repeat(d_grams, words.gram_counts, axis=0))


def fit(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", max_rows: tuple[int, int] = TRAIN_ROWS) -> Weights:
    """Weights fitted on the whole texts of about ``max_rows`` (toxic, other) labelled rows that meet ``training``.

    The driver holds these texts, whatever their lengths.
    """
    texts = docs.where(F.octet_length("text") > 0)
    known = labels.withColumn(label, F.least(F.greatest(F.col(label), F.lit(0)), F.lit(1)))
    parts = [labelled_rows(texts, known.where(F.col(label) == y), label, training, n) for y, n in zip((1, 0), max_rows, strict=True)]
    rows = parts[0].union(parts[1]).select("doc_id", "label", text_bytes(F.col("text")).alias("text")).collect()
    found = {(r.doc_id, bytes(r.text)): 0 for r in rows}
    for r in rows:
        found[r.doc_id, bytes(r.text)] |= r.label
    rows = sorted((i, y, t) for (i, t), y in found.items())
    return train([t for _, _, t in rows], np.array([y for _, y, _ in rows], dtype=np.float64))


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """``(doc_id, score)`` for each row; null and empty texts get the score of an empty window."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = classify(batch.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text"))).mapInArrow(scored, "doc_id long, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``(doc_id, held_out, score)`` for each row of ``docs``.

    Labels of documents whose CRC-32 leaves ``held_out`` modulo ``folds`` are never read. Nulls: a null id isn't held
    out, a null text counts as empty, null labels are left out; repeated rows each get their score. Without labels
    the scores mean nothing.
    """
    fold = doc_hash(F.col("doc_id"), folds)
    found = score(docs, fit(docs, labels, fold != held_out))
    return found.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score")


def drop_toxic(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score below ``threshold``; each row is judged by its own text."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(classify(list(texts), shared.value))

    name = unused_name(docs, "toxicity")
    marked = docs.withColumn(name, F.pandas_udf(scored, "double")(text_bytes(F.col("text"))))
    return marked.where(F.col(name) < threshold).drop(name)
