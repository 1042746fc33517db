"""Charsets that nothing declares: the likeliest one, by pairs of bytes counted in texts of the same kind."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Charsets that bodies are tried as; the first wins where none is likelier.
CHARSETS = ("utf-8", "windows-1252", "mac-roman", "cp850", "utf-16-le", "utf-16-be")
#: A pair of bytes at an even or an odd place, as units of two bytes tell these apart.
PAIRS = 1 << 17
#: What a pair counts that was never seen.
UNSEEN = 0.01
#: Bytes looked at at once; even, so that places keep their parity.
PART_BYTES = 1 << 20


def _pairs(body: bytes) -> Iterator[np.ndarray]:
    data = np.frombuffer(body, dtype=np.uint8).astype(np.int32)
    for start in range(0, max(0, len(data) - 1), PART_BYTES):
        part = data[start : start + PART_BYTES + 1]
        pairs = (part[:-1] << 8) + part[1:]
        pairs[1::2] += PAIRS // 2
        yield pairs


def pair_counts(texts: DataFrame, column: str, charsets: Iterable[str] = CHARSETS) -> DataFrame:
    """``(charset, pair, n)``: how often each pair of bytes stands in the texts, written in each charset.

    A text counts for the charsets that have all its characters. Each task adds up its own texts; the result has at
    most ``PAIRS`` rows a charset, however many texts there are.
    """
    names = tuple(charsets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(names), PAIRS), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).drop_null().to_pylist():
                for total, name in zip(totals, names, strict=True):
                    try:
                        body = text.encode(name)
                    except UnicodeEncodeError:
                        continue
                    for pairs in _pairs(body):
                        total += np.bincount(pairs, minlength=PAIRS)
        charset, pair = np.nonzero(totals)
        arrays = [pa.array(np.array(names, dtype=object)[charset], pa.string()), pa.array(pair, pa.int32()), pa.array(totals[charset, pair])]
        yield pa.RecordBatch.from_arrays(arrays, names=["charset", "pair", "n"])

    parts = texts.select(F.col(column).cast("string")).mapInArrow(count, "charset string, pair int, n long")
    return parts.groupBy("charset", "pair").agg(F.sum("n").alias("n"))


def charset_detector(model: DataFrame, charsets: Iterable[str] = CHARSETS) -> Callable[[Column], Column]:
    """A function from a column of bodies to their text in the likeliest charset that can hold them, else NULL.

    ``model`` is what :func:`pair_counts` found, or several of them added up; its size is bounded by the charsets.
    """
    names = tuple(charsets)
    counts = np.zeros((PAIRS, len(names)))
    for row in model.where(F.col("charset").isin(*names)).collect():
        counts[row.pair, names.index(row.charset)] += row.n
    scores = np.log((counts + UNSEEN) / (counts.sum(axis=0) + UNSEEN * PAIRS)).astype(np.float32)

    def read(body: bytes) -> str | None:
        total = np.zeros(len(names))
        for pairs in _pairs(body):
            total += scores[pairs].sum(axis=0, dtype=np.float64)
        for k in np.argsort(-total, kind="stable"):
            try:
                return body.decode(names[k])
            except UnicodeDecodeError:
                continue
        return None

    @F.arrow_udf("string")
    def detected(bodies: pa.Array) -> pa.Array:
        if bodies.null_count == len(bodies):
            return pa.nulls(len(bodies), pa.string())
        return pa.array([None if body is None else read(body) for body in bodies.to_pylist()], pa.string())

    return detected.asNondeterministic()
