"""Source divergence audit: how far the words of sources lie apart, in cells of a cube of group, group and term blocks."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.text import cuts, text_bytes
from sheaf.plans.staging import checkpointed

#: A language keeps the terms of so many of its documents.
MIN_DOCS = 10
#: The terms listed for each group.
TOP_TERMS = 10
#: Shares are whole numbers of this part.
SCALE = 1_000_000_000
#: Groups and terms of one block, about: a cell holds two blocks of groups on one block of terms.
GROUP_BLOCK = 32
TERM_BLOCK = 4096
#: Counts held before they are handed on, and bytes of a long text counted at once.
HELD_COUNTS = 400_000
PART_BYTES = 1 << 22

#: True for bytes of terms: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``.
TERM_BYTES = np.ones(256, dtype=bool)
TERM_BYTES[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if TERM_BYTES[b] else 0x20 for b in range(256))

CELL = "lang string, source string, item string, value long"


def _group(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents, in parts to be added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts, held = defaultdict(Counter), defaultdict(Counter), 0

        def flush() -> pa.RecordBatch:
            rows = [(lang, source, term, n, texts[lang, source][term]) for (lang, source), terms in counts.items() for term, n in terms.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            counts.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                group, text, seen = (lang.as_py(), source.as_py()), text.as_py(), set()
                before = len(counts[group])
                for part in cuts(text, TERM_BYTES, PART_BYTES) if len(text) > 2 * PART_BYTES else (text,):
                    words = part.translate(_TABLE).split()
                    counts[group].update(words)
                    seen.update(words)
                texts[group].update(seen)
                held += len(counts[group]) - before
                if held > HELD_COUNTS:
                    yield flush()
                    held = 0
        yield flush()

    found = docs.select(*_group(docs), text_bytes(F.col("text")).alias("text")).mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return found.withColumn("term", F.col("term").cast("string"))


def scaled(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * counts / totals)`` without rounding, for counts up to their totals, and totals below 9.2e15."""
    found, rest = np.zeros(np.broadcast(counts, totals).shape, dtype=np.int64), counts
    for _ in range(3):  # three digits at a time, as the whole product is more than 64 bits hold
        rest = rest * 1000
        found = found * 1000 + rest // totals
        rest = rest % totals
    return found + 1


def _scaled(count: str, total: str, n_terms: str) -> Column:
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10)) * CAST({count} + 2 AS DECIMAL(20))) div CAST({total} + 2 * {n_terms} AS DECIMAL(20))")


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def cell_sums(rows: pd.DataFrame, first: int, second: int) -> tuple[list[int], list[int], list[int]]:
    """Row numbers and partial divergences of all pairs of groups in one cell.

    Rows are the slices of two blocks of groups (or of one with itself) on one block of terms, of which each lists the
    terms it holds (``places``) with their ``counts``; all others of the block's ``size`` count as none.
    """
    size = int(rows["size"].iloc[0])
    totals = (rows["total"] + 2 * rows["n_terms"]).to_numpy()
    shares = np.repeat(scaled(np.full(len(rows), 2), np.maximum(totals, 1))[:, None], size, axis=1)
    for i, (places, counts) in enumerate(zip(rows["places"], rows["counts"], strict=True)):
        if places is not None and len(places):
            shares[i, places] = scaled(np.asarray(counts, dtype=np.int64) + 2, totals[i])
    blocks = rows["block"].to_numpy()
    one, other = np.flatnonzero(blocks == first), np.flatnonzero(blocks == second)
    a, b, values = [], [], []
    for k, i in enumerate(one.tolist()):
        partners = other[k + 1 :] if first == second else other
        apart = shares[partners] - shares[i]
        a.extend([i] * len(partners))
        b.extend(partners.tolist())
        values.extend((apart * apart // (shares[partners] + shares[i])).sum(axis=1).tolist())
    return a, b, values


def _cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    lang, first, second, _ = key
    rows = rows.sort_values("source", kind="stable")
    a, b, values = cell_sums(rows, first, second)
    names = rows["source"].to_numpy(dtype=object)
    return pd.DataFrame({"lang": lang, "source": names[a], "item": names[b], "value": np.array(values, dtype=np.int64)})


def source_divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for each group of documents of one language and source.

    Part ``pair`` lists all other sources of the language by their divergence, part ``term`` the ``top_terms`` terms
    that the group uses more than its language does. Both descend by value; ties go by the item's bytes. Null text,
    lang and source are read as empty; repeated rows are documents of their own, whatever their ids; an empty
    table gives no row. A group without terms, or in a language that keeps none, has all pairs (then of value 0).

    Terms are counted where they stand and added up once. A cell of the cube, (block of groups, block of groups,
    block of terms), is one task's work: it gets the slices of both blocks of groups, which are copied to each cell
    that needs them, and computes partial sums; these are added up along the terms. So no task grows with a
    language's documents, sources or terms; a long text is counted in parts.
    """
    groups = docs.select(*_group(docs)).distinct()
    # One shuffle: rows of one term and language meet, and are few, as each task has counted before.
    parts = term_counts(docs).repartition("lang", "term")
    counts = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    counts = counts.select("lang", "term", "source", "n", F.sum("docs").over(term).alias("docs"), F.sum("n").over(term).alias("lang_n"))
    counts = checkpointed(counts.where(F.col("docs") >= min_docs).drop("docs"))

    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(kept, "lang", "left")
    langs = langs.select(
        "lang",
        F.coalesce("n_terms", zero).alias("n_terms"),
        F.coalesce("lang_total", zero).alias("lang_total"),
        F.greatest(F.lit(1), F.ceil(F.col("n_terms") / term_block)).alias("term_blocks"),
        F.ceil(F.col("n_groups") / group_block).alias("group_blocks"),
    )
    # Written, so that joins by language see two plain tables, and a large language can be split.
    langs = checkpointed(langs)

    block = F.pmod(F.xxhash64("term"), F.col("term_blocks"))
    # Dealt anew, lest a language's blocks stay together where the join has put them.
    placed = terms.join(langs, "lang").select("lang", "term", block.alias("term_block")).repartition("lang", "term_block")
    place = F.row_number().over(Window.partitionBy("lang", "term_block").orderBy("term")) - 1
    placed = checkpointed(placed.select("lang", "term", "term_block", place.alias("place")))

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang")
    groups = checkpointed(groups.withColumn("total", F.coalesce("total", zero)).withColumn("block", F.pmod(F.xxhash64("source"), F.col("group_blocks"))))
    sizes = placed.groupBy("lang", "term_block").agg(F.count("*").alias("size"))

    entries = counts.join(placed, ["lang", "term"]).groupBy("lang", "source", "term_block").agg(F.collect_list(F.struct("place", "n")).alias("entries"))
    slices = groups.withColumn("term_block", F.explode(F.sequence(zero, F.col("term_blocks") - 1)))
    slices = slices.join(sizes, ["lang", "term_block"], "left").join(entries, ["lang", "source", "term_block"], "left")
    other = F.explode(F.sequence(zero, F.col("group_blocks") - 1)).alias("other")
    size = F.coalesce("size", zero).alias("size")
    slices = slices.select("lang", "source", "block", "term_block", size, "total", "n_terms", F.col("entries.place").alias("places"), F.col("entries.n").alias("counts"), other)
    cells = slices.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    sums = cells.groupBy("lang", "low", "high", "term_block").applyInPandas(_cell, CELL)
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = sums.select("lang", both.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _scaled("n", "total", "n_terms")).withColumn("q", _scaled("lang_n", "lang_total", "n_terms"))
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _divergence("p", "q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    top = over.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", rank).union(top)
