"""Secret scan: fixed patterns, and windows of high entropy that slide over candidate strings."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.text import text_bytes

# The patterns, and the least length of what they must find.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_VALUE = 6
ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Characters of a window.
WINDOW = 24
#: A candidate is cut into pieces of so many windows, which are slid over side by side.
PIECE = 1024
#: Pieces slid over at once.
PIECES = 4096


@dataclass(frozen=True)
class CharacterClass:
    """Strings of one alphabet; a window counts if its entropy reaches ``bits`` a character."""

    kind: str
    pattern: re.Pattern
    bits: float


#: Random windows have about 3.5 bits of at most 4 (hexadecimal) and 4.3 of at most 4.6 (base 64); words stay below.
CLASSES = (
    CharacterClass("entropy_hex", re.compile(rb"(?<![0-9A-Za-z+/_-])(?:[0-9A-F]{24,}|[0-9a-f]{24,})(?![0-9A-Za-z+/_-])"), 3.1),
    CharacterClass("entropy_base64", re.compile(rb"[A-Za-z0-9+/]{24,}={0,2}"), 4.1),
    CharacterClass("entropy_urlsafe", re.compile(rb"[A-Za-z0-9_-]{24,}={0,2}"), 4.1),
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))

#: What a found window is not to be: candidates that match one of these are no secrets.
ALLOWED = tuple(
    re.compile(p)
    for p in (
        rb"[0-9]+",  # decimal numbers
        rb"[A-Za-z]+",  # words run together
        rb"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",  # UUIDs
        rb"/?(?:[a-z_]+/){2,}[a-z_0-9]*",  # paths
        rb"[A-Za-z]+(?:[_-][A-Za-z]+)+[0-9]*",  # names of several words
        rb"(.{1,8}?)\1{2,}.{0,7}",  # repetitions
    )
)
#: Runs of so many characters of these alphabets, forwards, mark a sample.
SAMPLES = (b"0123456789abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
SAMPLE_RUN = 10
#: What stands before an integrity hash.
HASH_NAMES = (b"sha1-", b"sha256-", b"sha384-", b"sha512-")

FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"

Span = tuple[int, int, int]
"""Start and end in bytes, and the place of the kind in ``KINDS``."""


def base_spans(text: bytes) -> list[Span]:
    """What the fixed patterns find: leftmost matches that don't overlap, of each kind by itself."""
    found: list[Span] = []
    lower = text.lower()
    if any(name in lower for name in ASSIGN_NAMES):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if b"AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return found


def allowed(candidate: bytes, before: bytes = b"") -> bool:
    """True for strings that look random but are known kinds of names, numbers, hashes and samples.

    ``before``: some characters that stand before the candidate.
    """
    bare = candidate.rstrip(b"=")
    if before.endswith(HASH_NAMES) or bare.startswith(HASH_NAMES) or any(p.fullmatch(bare) for p in ALLOWED):
        return True
    return any(bare[i : i + SAMPLE_RUN] in sample for sample in SAMPLES for i in range(0, len(bare) - SAMPLE_RUN + 1, SAMPLE_RUN // 2))


def window_entropies(pieces: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """Shannon entropy, in bits a character, of each window of each piece.

    All pieces are read side by side: at each step a window takes one character in and lets one go, and only those
    two counts, and their terms of the sum, change.
    """
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    data = np.zeros((longest, len(pieces)), dtype=np.uint8)
    for k, i in enumerate(order.tolist()):
        data[: sizes[i], k] = np.frombuffer(pieces[i], dtype=np.uint8)
    terms = np.arange(window + 2, dtype=np.float64)
    terms[1:] *= np.log2(terms[1:])
    counts = np.zeros((len(pieces), 256), dtype=np.int64)
    total, found = np.zeros(len(pieces)), np.zeros((max(0, longest - window + 1), len(pieces)))
    rows = np.arange(len(pieces))
    alive = np.searchsorted(-sizes[order], -np.arange(1, longest + 1), side="right")
    for step, n in enumerate(alive.tolist()):
        if step >= window:
            away = counts[rows[:n], data[step - window, :n]]
            total[:n] -= terms[away] - terms[away - 1]
            counts[rows[:n], data[step - window, :n]] = away - 1
        added = counts[rows[:n], data[step, :n]] + 1
        total[:n] += terms[added] - terms[added - 1]
        counts[rows[:n], data[step, :n]] = added
        if step >= window - 1:
            found[step - window + 1, :n] = total[:n]
    entropies: list[np.ndarray] = [np.zeros(0)] * len(pieces)
    for k, i in enumerate(order.tolist()):
        entropies[i] = np.log2(window) - found[: max(0, sizes[i] - window + 1), k] / window
    return entropies


def _covered(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Ascending windows, given by their starts, as spans: those that touch are one."""
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return [(int(part[0]), int(part[-1]) + window) for part in np.split(starts, cut) if len(part)]


def _apart(spans: list[tuple[int, int]], known: list[Span]) -> list[tuple[int, int]]:
    """The spans that overlap no known one."""
    if not known:
        return spans
    known = sorted(known)
    starts = np.array([a for a, _, _ in known])
    reach = np.maximum.accumulate([b for _, b, _ in known])
    before = np.searchsorted(starts, [end for _, end in spans])
    return [span for span, n in zip(spans, before.tolist(), strict=True) if not n or reach[n - 1] <= span[0]]


def entropy_spans(texts: list[bytes], known: list[list[Span]], window: int = WINDOW) -> list[list[Span]]:
    """For each text the stretches covered by windows of high entropy.

    Candidates are the longest strings of each class's alphabet. Those on the allow-list are left out, and stretches
    that a span already ``known``, or one of an earlier class, overlaps.
    """
    found: list[list[Span]] = [[] for _ in texts]
    for number, chars in enumerate(CLASSES, start=3):
        owners: list[tuple[int, int, int]] = []
        pieces: list[bytes] = []
        hits: dict[tuple[int, int], list[np.ndarray]] = {}

        def slide(owners=owners, pieces=pieces, hits=hits, bits=chars.bits) -> None:
            for (text, start, shift), entropy in zip(owners, window_entropies(pieces, window), strict=True):
                high = np.flatnonzero(entropy >= bits)
                if len(high):
                    hits.setdefault((text, start), []).append(high + start + shift)
            owners.clear()
            pieces.clear()

        for i, text in enumerate(texts):
            for m in chars.pattern.finditer(text):
                if not allowed(m.group(), text[max(0, m.start() - 8) : m.start()]):
                    string = m.group().rstrip(b"=")
                    for shift in range(0, max(1, len(string) - window + 1), PIECE):
                        owners.append((i, m.start(), shift))
                        pieces.append(string[shift : shift + PIECE + window - 1])
                        if len(pieces) == PIECES:
                            slide()
        slide()
        added: dict[int, list[tuple[int, int]]] = {}
        for (i, _), parts in hits.items():
            added.setdefault(i, []).extend(_covered(np.concatenate(parts), window))
        for i, spans in added.items():
            found[i] += [(start, end, number) for start, end in _apart(spans, [*known[i], *found[i]])]
    return found


def _points(text: bytes, spans: list[Span]) -> list[Span]:
    """Spans with places in characters instead of bytes."""
    if not spans or text.isascii():
        return spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
    return [(int(before[a]), int(before[b]), kind) for a, b, kind in spans]


def _named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], s[2])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of each row of ``docs``: ``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy)``.

    ``spans`` lists kind:start:end in characters, by start, then in the order of ``KINDS``; the first three kinds are
    the fixed patterns', whose list alone ``base_sha256`` digests. Windows of high entropy add stretches where none
    of these lies. A null or empty text has none. Each row is judged by itself, so repeated rows have repeated
    results, ids may be null, and an empty table gives an empty one. Texts are read whole; a long candidate is
    cut into pieces that overlap by a window, so no window is lost.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(text) for text in texts]
            more = entropy_spans(texts, base)
            rows = []
            for text, known, added in zip(texts, base, more, strict=True):
                points = _points(text, known + added)
                fixed = points[: len(known)]
                kinds = [kind for _, _, kind in fixed]
                rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(_named(fixed).encode()).hexdigest(), _named(points), len(added)))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text")).mapInArrow(scan, FOUND)
