"""Quality classifier: a text is the mean of learned vectors of its words and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.samples import labelled_rows, sigmoid, text_parts
from sheaf.llm.text import CHUNK_BYTES, SEPARATOR, SPACED, doc_hash, span_hashes, text_bytes, word_bounds

#: The classifier is fitted on the whole texts of about so many labelled rows at most.
TRAIN_ROWS = 6000
#: Longer texts of these are counted where they are read, so that a row to the driver has about a megabyte at most.
LONG_BYTES = 1 << 20
BUCKET_BITS = 17
WIDTH = 16
GRAMS = (3, 4)
EPOCHS = 6
RATE = 0.5
SEED = 11

_CODES = np.random.default_rng(SEED).integers(1, 1 << 31, 256, dtype=np.uint32) | np.uint32(1)
_CODES[~SPACED] = _CODES[0x20]
_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x85EBCA6B)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams, and the text each belongs to.

    An n-gram lies within one word and the white space at its ends; bytes keep their case. Words and n-grams share
    the buckets.
    """
    data = np.frombuffer(SEPARATOR + SEPARATOR.join(texts) + SEPARATOR, dtype=np.uint8)
    owner_ends = np.cumsum([len(t) + 1 for t in texts])
    inside, codes = SPACED[data], _CODES[data]
    starts, ends = word_bounds(data, SPACED)
    buckets = [(span_hashes(data, starts, ends) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)]
    places = [starts]
    for n in GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        mixed, whole = np.full(size, n, dtype=np.uint32), np.ones(size, dtype=bool)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + size]) * _STEP + codes[k : k + size]
            if 0 < k < n - 1:
                whole &= inside[k : k + size]
        at = np.flatnonzero(whole)
        mixed = mixed[at]
        mixed = (mixed ^ (mixed >> np.uint32(15))) * _SPREAD
        buckets.append(((mixed ^ (mixed >> np.uint32(13))) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
        places.append(at + 1)
    return np.concatenate(buckets), np.searchsorted(owner_ends, np.concatenate(places), side="right").clip(max=len(texts) - 1)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text and how often it has each; a long one is counted in pieces."""
    times = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for _, parts in text_parts([text], SPACED, CHUNK_BYTES):
        times += np.bincount(features(parts)[0], minlength=len(times))
    found = np.flatnonzero(times)
    return found.astype(np.int32), times[found]


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent over texts' bags, one at a time; the weight of each bucket for class 1 against 0, and the bias."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)
    output = np.zeros((WIDTH, 2), dtype=np.float32)
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    bias = np.log(np.array([1 - share, share], dtype=np.float32))
    bags = [(found, (times / max(1, times.sum())).astype(np.float32)) for found, times in bags]
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            found, part = bags[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            mean = part @ vectors[found]
            logits = mean @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[int(labels[i])] -= 1
            vectors[found] -= rate * len(found) ** 0.5 * part[:, None] * (output @ error)
            output -= rate * np.outer(mean, error)
            bias -= rate * np.float32(0.1) * error
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def classify(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """Softmax probability of class 1 for each whole text."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for owners, parts in text_parts(texts, SPACED, CHUNK_BYTES):
        found, part = features(parts)
        total += np.bincount(owners[part], weights=weights[found], minlength=len(texts))
        count += np.bincount(owners[part], minlength=len(texts))
    return sigmoid(total / np.maximum(count, 1) + bias)


def fit(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", max_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights fitted on about ``max_rows`` labelled rows whose ``doc_id`` meets ``training``.

    Whole texts are learned from. Without labelled rows every score is 0.5.
    """
    sample = labelled_rows(docs, labels, label, training, max_rows).where(F.octet_length("text") > 0)
    rows = sample.select("doc_id", "label", text_bytes(F.col("text")).alias("text"))
    rows = sorted(rows.mapInArrow(_shortened, "doc_id long, label int, text binary, found binary, times binary").collect(), key=lambda r: (r.doc_id, r.label))
    if not rows:
        return np.zeros(1 << BUCKET_BITS, dtype=np.float32), 0.0
    bags = [bag(bytes(r.text)) if r.text is not None else (np.frombuffer(r.found, np.int32), np.frombuffer(r.times, np.int64)) for r in rows]
    return train(bags, np.array([min(1, max(0, r.label)) for r in rows]))


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts above ``LONG_BYTES`` as their bags."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        bags = [bag(t) if len(t) > LONG_BYTES else None for t in texts]
        columns = [
            batch.column(0).cast(pa.int64()), batch.column(1), pa.array([t if b is None else None for t, b in zip(texts, bags, strict=True)], pa.binary()),
            *(pa.array([b and b[k].tobytes() for b in bags], pa.binary()) for k in (0, 1)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "text", "found", "times"])


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """``(doc_id, score)`` for each row: the whole text's probability of class 1; null and empty texts get the bias's."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = classify(batch.column(1).to_pylist(), *shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text"))).mapInArrow(scored, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """``(doc_id, held_out, score)`` for each row of ``docs``.

    Labels of documents whose CRC-32 leaves ``held_out`` modulo ``folds`` are never read. Nulls: a null id isn't held
    out, a null text counts as empty, null labels are left out; repeated rows each get their score.
    """
    fold = doc_hash(F.col("doc_id"), folds)
    weights, bias = fit(docs, labels, fold != held_out)
    return score(docs, weights, bias).select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score")
