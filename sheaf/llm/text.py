"""Words of whole texts as numpy arrays: many texts at once, joined by a byte that belongs to no word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once. A longer text is cut between words where an operator allows it.
CHUNK_BYTES = 1 << 18
SEPARATOR = b"\n"

#: True for bytes of words without ASCII white space: ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: True for bytes of words of letters and digits: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_rng = np.random.default_rng(20240229)
_BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def doc_hash(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the id's text, modulo: the split into parts for training and for holding out; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def text_bytes(text: Column) -> Column:
    return F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number with its bits spread over the whole word."""
    x = x.astype(np.uint64, copy=False)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes together; a longer text is a range of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased (ASCII) bytes of all texts with a separator before, between and after; where each text starts, and the end."""
    data = np.frombuffer(SEPARATOR + SEPARATOR.join(texts) + SEPARATOR, dtype=np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts = np.ones(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    starts[1:] += 1
    return data, starts


def word_bounds(data: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last; ``data`` starts and ends outside of words."""
    inside = letters[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[0::2], edges[1::2]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        if n > 4 * CHUNK_BYTES:
            return tables[0], tables[1]
        _powers = tables[0], tables[1]
    return _powers[0][:n], _powers[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(texts: list[bytes], letters: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each range of texts: its first index, the hashes of its words, and where each text's words start (and the end)."""
    for i, j in runs(texts, limit):
        if j - i == 1 and len(texts[i]) > 2 * limit:
            found = [h for part in cuts(texts[i], letters, limit) for _, h, _ in word_hashes([part], letters, len(part))]
            hashes = np.concatenate(found)
            yield i, hashes, np.array([0, len(hashes)])
            continue
        data, at = joined(texts[i:j])
        starts, ends = word_bounds(data, letters)
        yield i, span_hashes(data, starts, ends), np.searchsorted(starts, at)


def cuts(text: bytes, letters: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A long text in parts of about ``limit`` bytes that end between words."""
    data = np.frombuffer(text, dtype=np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    start = 0
    while start < len(text):
        end = min(len(text), start + limit)
        while end < len(text):
            gap = np.flatnonzero(~letters[data[end : end + limit]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(text), end + limit)
        yield text[start:end]
        start = end
