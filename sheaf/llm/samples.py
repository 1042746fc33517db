"""Bounded samples of labelled rows to fit classifiers on, and the walk over whole texts that scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.text import cuts, runs

HASH_RANGE = 1 << 20


def share_of(key: Column, share: Column | float) -> Column:
    """True for about that share of the keys, chosen by a hash; the same keys on every run."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit("sample")), F.lit(HASH_RANGE)) < share * HASH_RANGE


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, training: Column, max_rows: int) -> DataFrame:
    """``(doc_id, label, text)`` of about ``max_rows`` labelled training documents, all of them where there are fewer.

    A document with several labels gets the largest; an id with several texts gives the smallest. So the rows number
    about ``max_rows``, however large the input and however often an id is repeated, and the ids can be broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & training)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    total = known.count()
    chosen = known.where(share_of(F.col("doc_id"), min(1.0, max_rows / max(total, 1))))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def text_parts(texts: list[bytes], letters: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """All texts in groups of about ``limit`` bytes: for each part the text it is of. A longer text is cut between words."""
    owners, parts = [], []
    for i, text in enumerate(texts):
        for part in cuts(text, letters, limit) if len(text) > 2 * limit else (text,):
            owners.append(i)
            parts.append(part)
    for i, j in runs(parts, limit):
        yield np.array(owners[i:j], dtype=np.int64), parts[i:j]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))
