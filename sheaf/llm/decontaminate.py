"""Benchmark decontamination: spaced seeds find passages of a benchmark that survive replaced words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.text import ALNUM, mixed, text_bytes, unused_name, word_hashes

#: Fixed masks over consecutive words; a word at 0 may be any.
MASKS = ("1111111", "110110111", "1101011011", "11100100111")
#: An overlap counts from so many words, of which so large a part must be equal.
MIN_WORDS = 12
MIN_EQUAL = 0.75
#: Bytes of benchmark text that one pass over the documents compares with.
BLOCK_BYTES = 8 << 20
#: Hits of one text that are verified at once.
HITS = 1 << 16

FOUND = "doc_id long, item_id long, start long, words long, item_start long, equal long"


@dataclass
class Index:
    """The words of one block of a benchmark, end to end, and its seeds in order of their hashes."""

    words: np.ndarray
    bounds: np.ndarray
    item_ids: list[int | None]
    items: np.ndarray
    seeds: np.ndarray
    places: np.ndarray
    filter: np.ndarray
    shift: np.uint64
    masks: tuple[str, ...]

    def may_hold(self, seeds: np.ndarray) -> np.ndarray:
        """Whether each seed may be in the index: a look at one bit."""
        at = (seeds >> self.shift).astype(np.int64)
        return (self.filter[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def seed_hashes(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """A hash of the masked words from each place on where the mask fits."""
    size = len(words) - len(mask) + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(size, salt, dtype=np.uint64)
    for k, kept in enumerate(mask):
        if kept == "1":
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += words[k : k + size]
    return mixed(total)


def build_index(items: list[tuple[int | None, bytes]], masks: tuple[str, ...] = MASKS) -> Index:
    """An item that is shorter than the shortest mask is indexed as a whole, by a mask of its own length."""
    words, bounds = [], [0]
    for _, at, starts in word_hashes([text for _, text in items], ALNUM):
        words.append(at)
        bounds.extend(bounds[-1] + np.diff(starts).cumsum())
    words = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    bounds = np.array(bounds, dtype=np.int64)
    lengths = np.diff(bounds)
    owner = np.repeat(np.arange(len(items), dtype=np.int32), lengths)
    shortest = min(map(len, masks), default=0)
    masks = (*masks, *("1" * int(n) for n in np.unique(lengths[(lengths > 0) & (lengths < shortest)])))
    seeds, places = [], []
    for salt, mask in enumerate(masks):
        found = seed_hashes(words, mask, salt)
        at = np.arange(len(found), dtype=np.int32)
        one_item = owner[at] == owner[at + len(mask) - 1] if len(at) else np.zeros(0, dtype=bool)
        if len(at) and len(mask) < shortest:
            one_item &= lengths[owner[at]] == len(mask)
        seeds.append(found[one_item])
        places.append(at[one_item])
    seeds, places = np.concatenate(seeds), np.concatenate(places)
    order = np.argsort(seeds, kind="stable")
    bits = max(16, int(max(1, len(seeds)) - 1).bit_length() + 4)
    present = np.zeros(1 << (bits - 3), dtype=np.uint8)
    shift = np.uint64(64 - bits)
    at = (seeds >> shift).astype(np.int64)
    np.bitwise_or.at(present, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    return Index(words, bounds, [i for i, _ in items], owner, seeds[order], places[order], present, shift, masks)


def _hits(words: np.ndarray, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the text and of the index with equal seeds."""
    for salt, mask in enumerate(index.masks):
        found = seed_hashes(words, mask, salt)
        at = np.flatnonzero(index.may_hold(found))
        low = np.searchsorted(index.seeds, found[at], "left")
        count = np.searchsorted(index.seeds, found[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        ends = np.cumsum(count)
        start = 0
        while start < len(at):  # in parts, as a seed may stand in many items
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HITS, "right")))
            part = slice(start, stop)
            n = count[part]
            steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(at[part], n), index.places[np.repeat(low[part], n) + steps]
            start = stop


def best_stretches(equal: np.ndarray, min_words: int, min_equal: float) -> Iterator[tuple[int, int, int]]:
    """``(start, end, number of equal)`` of the stretches that are long and equal enough, ascending.

    First comes the stretch with the largest sum of +1 for an equal and -3/2 for a replaced word, then in the same
    way what is left on both sides of it.
    """
    before = np.concatenate([[0], np.cumsum(equal)])
    sums = 2.5 * before - 1.5 * np.arange(len(before))
    found, parts = [], [(0, len(equal))]
    while parts:
        low, high = parts.pop()
        if high - low < min_words or before[high] - before[low] < min_equal * min_words:
            continue
        part = sums[low : high + 1]
        end = low + int(np.argmax(part - np.minimum.accumulate(part)))
        start = low + int(np.argmin(sums[low : end + 1]))
        if end == start:
            continue
        same = int(before[end] - before[start])
        if end - start >= min_words and same >= min_equal * (end - start):
            found.append((start, end, same))
        parts += [(low, start), (end, high)]
    return iter(sorted(found))


def overlaps(words: np.ndarray, index: Index, min_words: int = MIN_WORDS, min_equal: float = MIN_EQUAL) -> Iterator[tuple[int, int, int, int, int]]:
    """``(item, start, words, item_start, equal)`` for each verified overlap of one text with the items.

    Around each hit the text and the item are laid side by side without gaps. Of the places on that diagonal where
    both have words, all stretches count that are long and equal enough. An item shorter than ``min_words`` must be
    covered whole.
    """
    diagonals: dict[tuple[int, int], None] = {}
    for at, place in _hits(words, index):
        item = index.items[place]
        pairs = np.unique(np.stack([item, at - (place - index.bounds[item])], axis=1), axis=0)
        diagonals.update(dict.fromkeys(map(tuple, pairs.tolist())))
    for item, offset in sorted(diagonals):
        own = index.words[index.bounds[item] : index.bounds[item + 1]]
        low, high = max(0, offset), min(len(words), offset + len(own))
        equal = words[low:high] == own[low - offset : high - offset]
        for start, end, same in best_stretches(equal, min(min_words, len(own)), min_equal):
            yield item, low + start, end - start, low + start - offset, same


def contaminations(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS, min_equal: float = MIN_EQUAL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each overlap of a document with a benchmark item: word positions and the number of equal words.

    Words are runs of letters and digits, ASCII ones lower-cased. The benchmark is the query set: it is cut by a hash
    into blocks of about ``block_bytes``, and each block is shipped to one pass over all documents, so memory doesn't
    grow with it. Null and empty texts overlap with nothing, items of fewer words than the shortest
    mask must stand word by word; repeated rows give repeated results; ids may be null.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    slim = docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text")))
    found = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(build_index(sorted(((r.item_id, bytes(r.text)) for r in rows), key=lambda r: (r[0] is None, r)), masks))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                for first, words, starts in word_hashes(batch.column(1).to_pylist(), ALNUM):
                    # One look at all the texts' seeds tells which of them to look at closely.
                    near = np.zeros(len(words) + 1, dtype=bool)
                    for salt, mask in enumerate(index.masks):
                        seeds = seed_hashes(words, mask, salt)
                        near[: len(seeds)] |= index.may_hold(seeds)
                    hit = np.unique(np.searchsorted(starts, np.flatnonzero(near), side="right") - 1)
                    for k in hit[hit < len(starts) - 1]:
                        for item, start, length, item_start, same in overlaps(words[starts[k] : starts[k + 1]], index, min_words, min_equal):
                            rows.append((ids[first + k], index.item_ids[item], start, length, item_start, same))
                arrays = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "start", "words", "item_start", "equal"])

        part = slim.mapInArrow(search, FOUND)
        found = part if found is None else found.union(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark passage; rows without an id are judged by their text.

    A document found in any row goes with all rows of its id. A row without id and text holds nothing and stays.
    """
    key = unused_name(docs, "row_key")
    gone = contaminations(docs.where("doc_id IS NOT NULL"), benchmark, **options).select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti")
    # Rows without an id are told apart by their text; ids and hashes are kept apart, as they may be equal.
    nameless = docs.where("doc_id IS NULL").withColumn(key, F.xxhash64("text"))
    held = contaminations(nameless.select(F.col(key).alias("doc_id"), "text"), benchmark, **options)
    nameless = nameless.join(held.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti")
    return named.unionByName(nameless.select(*docs.columns)).select(*docs.columns)
