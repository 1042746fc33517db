"""Line dedup: passages that an earlier document holds too are found by line hashes, aligned, and deleted."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.text import text_bytes, unused_name
from sheaf.plans.staging import checkpointed

#: An aligned block is deleted from so many words on.
MIN_WORDS = 20
#: Lines of one block follow each other in both documents with fewer than so many other lines between them.
MAX_GAP = 3

#: A line with so many holders at most leads each of them to all earlier ones; a more frequent one to the first.
RARE = 8

#: ``key`` tells apart the texts of one id; ``pos`` counts lines that aren't blank; ``nth``: how often the line has stood
#: in the document so far. ``run``: the shortest run of several lines from here on with the words of a block, if
#: there is one, with its number of lines; ``run_nth``: how often it has.
LINES = "doc_id long, key long, pos long, line long, nth long, words long, run long, run_nth long, size long"
_NONE = -1
#: White space at the ends of a line, as bytes have it.
_BLANK = " \t\n\r\x0b\x0c"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _text_lines(text: bytes, min_words: int) -> np.ndarray:
    """The columns from ``pos`` on of :data:`LINES` for one text."""
    stripped = [line.strip() for line in text.split(b"\n")]
    stripped = [line for line in stripped if line]
    table = np.full((len(stripped), 7), _NONE, dtype=np.int64)
    table[:, 0] = np.arange(len(stripped))
    table[:, 3] = words = [len(line.split()) for line in stripped]
    table[:, 1] = hashes = [_signed(xxhash.xxh64_intdigest(line)) for line in stripped]
    sums = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    ends = np.searchsorted(sums, sums[:-1] + min_words)
    codes = np.array(hashes, dtype="<i8").tobytes()
    seen: dict[int, int] = {}
    runs: dict[int, int] = {}
    for i, (line, end) in enumerate(zip(hashes, ends.tolist(), strict=True)):
        table[i, 2] = seen[line] = seen.get(line, -1) + 1
        if i + 1 < end <= len(hashes):
            run = _signed(xxhash.xxh64_intdigest(codes[8 * i : 8 * end]))
            runs[run] = runs.get(run, -1) + 1
            table[i, 4:] = run, runs[run], end - i
    return table


def line_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each line that isn't blank, by the hash of the line without white space at its ends."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            held: list[np.ndarray] = []
            size = 0
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                text = text.as_py()
                table = _text_lines(text, min_words)
                own = np.broadcast_to(np.array([doc_id, _signed(xxhash.xxh64_intdigest(text))]), (len(table), 2))
                held.append(np.concatenate([own, table], axis=1))
                size += len(table)
                if size > 1 << 16:
                    yield _batch(held)
                    held, size = [], 0
            yield _batch(held)

    slim = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")))
    return slim.mapInArrow(split, LINES)


def _batch(tables: list[np.ndarray]) -> pa.RecordBatch:
    names = [column.split()[0] for column in LINES.split(", ")]
    table = np.concatenate([np.zeros((0, len(names)), dtype=np.int64), *tables])
    return pa.RecordBatch.from_arrays([pa.array(table[:, i]) for i in range(len(names))], names=names)


def longest_increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience sorting."""
    piles: list[int] = []
    tops: list[int] = []
    below = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(piles, value)
        below[i] = tops[pile - 1] if pile else -1
        if pile == len(piles):
            piles.append(value)
            tops.append(i)
        else:
            piles[pile], tops[pile] = value, i
    found, i = [], tops[-1] if tops else -1
    while i >= 0:
        found.append(i)
        i = below[i]
    return found[::-1]


def common_blocks(matches: list[tuple[int, int, int]], min_words: int = MIN_WORDS, max_gap: int = MAX_GAP) -> list[int]:
    """Positions in the later document to delete, from ``(position, position in the earlier one, words)`` of equal lines.

    Equal lines that keep their order in both documents are aligned; runs of them with small gaps are blocks. What the
    alignment leaves out is aligned again, as a block may have moved; so each match is aligned once.
    """
    left, found = sorted(matches), []
    while left:
        chain = longest_increasing([earlier for _, earlier, _ in left])
        block: list[tuple[int, int, int]] = []
        for match in [left[i] for i in chain] + [None]:
            if block and (match is None or match[0] - block[-1][0] > max_gap or match[1] - block[-1][1] > max_gap):
                if sum(words for _, _, words in block) >= min_words:
                    found.extend(pos for pos, _, _ in block)
                block = []
            if match is not None:
                block.append(match)
        aligned = set(chain)
        left = [x for i, x in enumerate(left) if i not in aligned]
    return sorted(found)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_gap: int = MAX_GAP) -> DataFrame:
    """``(doc_id, key, gone)`` for each document that loses lines: their positions among those not blank, from 0.

    Rare lines find the pairs: the n-th occurrence of a line that up to ``RARE`` documents have so often is matched
    with the n-th in all earlier ones of them, that of a more frequent line in the first one. A document is aligned
    with each earlier one found so. For passages of frequent lines alone, which may meet in no such pair, there is an
    exact way: each shortest run of lines with the words of a block is looked up in the first document that has it,
    and goes as it stands there. So a passage that an earlier document holds line by line is found however frequent
    its lines are, and no line costs more than a bounded number of rows for each of its places. The first occurrence
    always stays.
    """
    lines = checkpointed(line_rows(docs, min_words))
    first = lines.groupBy("line", "nth").agg(F.min(F.struct("doc_id", "key", "pos")).alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("holders"))
    # Written before the joins, so that a line that very many documents hold can be split.
    first = checkpointed(first.where("last > first.doc_id").select("line", "nth", "first", "holders"))
    here = ("doc_id", "key", "pos", "line", "nth", "words")
    matched = checkpointed(lines.select(*here).join(first, ["line", "nth"]).where("doc_id > first.doc_id"))
    to_first = matched.select("doc_id", "key", F.col("first.doc_id").alias("early"), F.col("first.key").alias("early_key"), F.struct("pos", F.col("first.pos").alias("early_pos"), "words").alias("match"))
    rare = matched.where(F.col("holders") <= RARE)
    before = rare.select("line", "nth", F.col("doc_id").alias("early"), F.col("key").alias("early_key"), F.col("pos").alias("early_pos"))
    to_rest = rare.join(before, ["line", "nth"]).where("doc_id > early").select("doc_id", "key", "early", "early_key", F.struct("pos", "early_pos", "words").alias("match"))
    pair = to_first.union(to_rest)
    pairs = pair.groupBy("doc_id", "key", "early", "early_key").agg(F.collect_set("match").alias("matches"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = batch.column(2).to_pylist()
            gone = [common_blocks([(m["pos"], m["early_pos"], m["words"]) for m in x], min_words, max_gap) for x in matches]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int64()))], names=["doc_id", "key", "part"])

    # Few words in all: no block can be long enough.
    long_enough = F.aggregate("matches", F.lit(0).cast("long"), lambda total, m: total + m["words"]) >= min_words
    aligned = pairs.where(long_enough).select("doc_id", "key", "matches").mapInArrow(align, "doc_id long, key long, part array<long>")
    runs = lines.where("size > 0").select("doc_id", "key", "pos", "run", "run_nth", "size")
    held = runs.groupBy("run", "run_nth").agg(F.min("doc_id").alias("early"), F.max("doc_id").alias("last")).where("last > early")
    whole = runs.join(checkpointed(held.drop("last")), ["run", "run_nth"]).where("doc_id > early")
    whole = whole.select("doc_id", "key", F.sequence("pos", F.col("pos") + F.col("size") - 1).alias("part"))
    gone = aligned.where(F.size("part") > 0).union(whole).groupBy("doc_id", "key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("part")))).alias("gone"))
    return gone


def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    def cut(text: str | None, lines: np.ndarray | None) -> str | None:
        if text is None or lines is None:
            return text
        away, kept, pos = set(lines.tolist()), [], 0
        for line in text.split("\n"):
            if not line.strip(_BLANK):
                kept.append(line)
                continue
            if pos not in away:
                kept.append(line)
            pos += 1
        return "\n".join(kept)

    return pd.Series([cut(t, g) for t, g in zip(texts, gone, strict=True)], dtype=object)


def text_key(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(xxhash.xxh64_intdigest(t or b"")) for t in texts], dtype="int64")


def deduplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_gap: int = MAX_GAP, removed: str | None = None) -> DataFrame:
    """``docs`` without the passages that a document with a smaller id holds too; all rows and columns stay.

    ``removed``: a column to add, the number of lines deleted. A text that loses all its lines becomes empty; a null
    text stays null; rows with a null id are neither changed nor compared. Rows that share an id aren't compared with
    each other; repeated rows lose the same lines. A long text is read by one task, line by line; an empty table
    gives an empty one.
    """
    key, gone = unused_name(docs, "text_key"), unused_name(docs, "gone_lines")
    found = repeated_lines(docs, min_words, max_gap).select(F.col("doc_id"), F.col("key").alias(key), F.col("gone").alias(gone))
    keyed = docs.withColumn(key, F.pandas_udf(text_key, "long")(text_bytes(F.col("text"))))
    joined = keyed.join(found, ["doc_id", key], "left")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.pandas_udf(_without, "string")(F.col("text"), F.col(gone)))
    columns = [text.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return joined.select(*columns, *([F.coalesce(F.size(gone), F.lit(0)).alias(removed)] if removed else []))
