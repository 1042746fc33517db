"""Language identification: a convolutional network over the bytes of fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.samples import share_of
from sheaf.llm.text import doc_hash, text_bytes

#: Fitted on all windows of about so many rows at most, equal shares for the languages.
TRAIN_ROWS = 3000
WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
DEPTH = 8
EPOCHS = 2
BATCH = 64
RATE = 0.02
SEED = 5
UNKNOWN = "und"
#: Windows that one step of scoring holds.
WINDOWS = 256

_WIDEST = max(WIDTHS)
_STRIDE = WINDOW - _WIDEST + 1
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray


def _patches(windows: np.ndarray, embedding: np.ndarray) -> np.ndarray:
    """For each window and place the embedded bytes that a filter sees; after the end come zero bytes."""
    padded = np.zeros((len(windows), WINDOW + _WIDEST - 1), dtype=np.uint8)
    padded[:, :WINDOW] = windows
    embedded = embedding[padded]
    depth = embedding.shape[1]
    n, _, item = embedded.strides
    shape = (len(windows), WINDOW, _WIDEST * depth)
    return np.lib.stride_tricks.as_strided(embedded, shape, (n, depth * item, item)).reshape(-1, shape[2])


def _filter_mask() -> np.ndarray:
    mask = np.zeros((_WIDEST * DEPTH, FILTERS * len(WIDTHS)), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * DEPTH, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def log_probabilities(windows: np.ndarray, net: Network) -> np.ndarray:
    found = (_patches(windows, net.embedding) @ net.filters).reshape(len(windows), WINDOW, -1).max(axis=1)
    logits = np.maximum(found + net.bias, 0) @ net.output + net.output_bias
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def window_rows(text: bytes) -> np.ndarray:
    """All windows of a lower-cased text, which overlap by the widest filter less one; the last is filled with zeros."""
    count = max(1, -(-(len(text) - _WIDEST + 1) // _STRIDE))
    filled = np.zeros((count - 1) * _STRIDE + WINDOW, dtype=np.uint8)
    filled[: len(text)] = np.frombuffer(text, dtype=np.uint8)[: len(filled)]
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW)[::_STRIDE]


def train(texts: list[bytes], classes: np.ndarray, languages: list[str]) -> Network:
    """Adam over batches of all texts' windows; the gradient of max pooling goes to the place of the maximum."""
    rng = np.random.default_rng(SEED)
    mask = _filter_mask()
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        (rng.normal(0, 0.2, mask.shape) * mask).astype(np.float32),
        np.zeros(mask.shape[1], dtype=np.float32),
        rng.normal(0, 0.1, (mask.shape[1], len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    )
    rows = [window_rows(t) for t in texts]
    windows, classes = np.concatenate(rows), np.repeat(classes, [len(r) for r in rows])
    names = ("embedding", "filters", "bias", "output", "output_bias")
    moments = {n: [np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))] for n in names}
    step = 0
    total = EPOCHS * -(-len(windows) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            n = len(batch)
            patches = _patches(windows[batch], net.embedding).reshape(n, WINDOW, -1)
            maps = patches @ net.filters
            best = maps.argmax(axis=1)
            pooled = np.take_along_axis(maps, best[:, None], axis=1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            logits = hidden @ net.output + net.output_bias
            error = np.exp(logits - logits.max(axis=1, keepdims=True))
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(n), classes[batch]] -= 1
            error /= n
            back = (error @ net.output.T) * (pooled > 0)
            seen = patches[np.arange(n)[:, None], best]
            into = (back[:, :, None] * net.filters.T[None]).reshape(n, -1, _WIDEST, DEPTH)
            places = np.zeros((n, WINDOW + _WIDEST - 1), dtype=np.int64)
            places[:, :WINDOW] = windows[batch]
            places = places[np.arange(n)[:, None, None], best[:, :, None] + np.arange(_WIDEST)]
            embedded = np.stack([np.bincount(places.ravel(), into[..., d].ravel(), minlength=256) for d in range(DEPTH)], axis=1)
            gradients = {
                "embedding": embedded.astype(np.float32),
                "filters": np.einsum("nf,nfk->kf", back, seen) * mask,
                "bias": back.sum(axis=0),
                "output": hidden.T @ error,
                "output_bias": error.sum(axis=0),
            }
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for name, gradient in gradients.items():
                mean, square = moments[name]
                mean += 0.1 * (gradient - mean)
                square += 0.01 * (gradient**2 - square)
                change = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
                setattr(net, name, (getattr(net, name) - change).astype(np.float32))
    return net


def fit(docs: DataFrame, training: Column, max_rows: int = TRAIN_ROWS) -> Network | None:
    """A network fitted on the whole texts of about ``max_rows`` rows, which the driver holds; None without labelled text."""
    known = docs.where(training & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    counts = {r.lang: r["count"] for r in known.select("lang").groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    each = max_rows / len(languages)
    share = F.element_at(F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, each / counts[k]))))), F.col("lang"))
    # One row an id, however often it is repeated: the collected rows are bounded by ``max_rows``.
    rows = known.where(share_of(F.col("doc_id"), share)).select("doc_id", F.struct("lang", text_bytes(F.col("text")).alias("text")).alias("row"))
    rows = rows.groupBy("doc_id").agg(F.min("row").alias("row")).select("doc_id", "row.*").collect()
    rows = sorted((r.doc_id, r.lang, bytes(r.text)) for r in rows)
    classes = np.array([languages.index(lang) for _, lang, _ in rows], dtype=np.int64)
    if not rows:
        return None
    return train([t.translate(_LOWER) for _, _, t in rows], classes, languages)


def has_letter(text: bytes) -> bool:
    """Whether any character of the text is a letter of some script."""
    if text[:64].translate(_LOWER).strip(bytes(set(range(256)) - set(range(97, 123)))):
        return True
    return any(c.isalpha() for i in range(0, len(text), 4090) for c in text[i : i + 4096].decode("utf-8", "ignore"))


def identify(texts: list[bytes], net: Network) -> tuple[list[str], list[float]]:
    """The likeliest language of each whole text by the summed log-probabilities of all its windows, and its probability."""
    sums = np.zeros((len(texts), len(net.languages)))
    owners: list[np.ndarray] = []
    waiting: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        np.add.at(sums, np.concatenate(owners), log_probabilities(np.concatenate(waiting), net))
        owners.clear()
        waiting.clear()

    for i, text in enumerate(texts):
        windows = window_rows(text.translate(_LOWER))
        for start in range(0, len(windows), WINDOWS):
            part = windows[start : start + WINDOWS]
            owners.append(np.full(len(part), i))
            waiting.append(part)
            held += len(part)
            if held >= WINDOWS:
                flush()
                held = 0
    if waiting:
        flush()
    sums -= sums.max(axis=1, keepdims=True)
    odds = np.exp(sums)
    odds /= odds.sum(axis=1, keepdims=True)
    best = odds.argmax(axis=1)
    lettered = [has_letter(t) for t in texts]
    names = [net.languages[b] if letter else UNKNOWN for b, letter in zip(best, lettered, strict=True)]
    return names, [float(odds[i, b]) if lettered[i] else 0.0 for i, b in enumerate(best)]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row. A null text, one without a letter, or no network: ``und`` and 0."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not texts:
                continue
            names, odds = identify(texts, shared.value) if shared.value else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(odds, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    slim = docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text")))
    return slim.mapInArrow(named, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row of ``docs``.

    Learns from text and ``lang`` of rows whose CRC-32 doesn't leave ``held_out`` modulo ``folds``. A null id isn't
    held out and isn't learned from; a null ``lang`` isn't learned from; repeated rows each get their prediction.
    """
    fold = doc_hash(F.col("doc_id"), folds)
    found = predict(docs, fit(docs, fold != held_out))
    return found.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
