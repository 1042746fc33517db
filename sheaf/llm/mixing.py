"""Mixing sources to target weights: exact quotas of blocks, split among output shards by a hypergeometric tree."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.text import text_bytes, unused_name
from sheaf.plans.staging import checkpointed

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: A source's permuted documents are laid end to end and cut into blocks of so many words.
BLOCK_WORDS = 64
SHARD_WORDS = 1_000_000
#: Documents of one source that are put in order together.
BUCKET_ROWS = 4096
#: The totals of the sources are held by the driver and sent to all tasks; more sources than this are refused.
MAX_SOURCES = 1_000_000
SEED = 17
#: Above so many units the generator's hypergeometric draw isn't defined, and binomial draws are corrected instead.
LARGEST_DRAW = 10**9 - 1
#: So few units are drawn one by one.
FEW = 64
#: Numbers that a task keeps of the splits it has drawn.
KEPT_NUMBERS = 1 << 22


def drawn(rng: np.random.Generator, quotas: np.ndarray, size: int) -> np.ndarray:
    """How many of each source's units are among ``size`` of all, drawn without replacement.

    Large totals: each unit is taken with about the right probability; whatever came of it is a uniform choice of its
    size, from which the excess is drawn to be put back, or to which the lack is drawn from those left. That is the same
    draw of about the root of the size, so a few rounds do; and it is exact, whatever the probability.
    """
    total = int(quotas.sum())
    if total <= LARGEST_DRAW:
        return rng.multivariate_hypergeometric(quotas, size, method="marginals")
    if size <= FEW:
        left, found = quotas.copy(), np.zeros_like(quotas)
        for _ in range(size):
            source = np.searchsorted(np.cumsum(left), rng.integers(int(left.sum())), side="right")
            left[source] -= 1
            found[source] += 1
        return found
    found = rng.binomial(quotas, size / total)
    excess = int(found.sum()) - size
    if excess > 0:
        return found - drawn(rng, found, excess)
    return found + drawn(rng, quotas - found, -excess) if excess else found


@dataclass
class Tree:
    """Splits the sources' quotas among shards; any task can follow a unit to its shard."""

    quotas: np.ndarray
    shards: int
    seed: int = SEED
    _known: dict[tuple[int, int], np.ndarray] = field(default_factory=dict, repr=False)

    def _until(self, shard: int) -> int:
        """Units in all shards before this one."""
        return int(self.quotas.sum()) * shard // self.shards

    def split(self, quotas: np.ndarray, low: int, middle: int, high: int) -> np.ndarray:
        """How much of each source's quota goes to the shards below ``middle``: a draw without replacement."""
        size = self._until(middle) - self._until(low)
        known = self._known.get((low, high))
        if known is None:
            known = drawn(np.random.default_rng([self.seed, low, high]), quotas, size)
            if len(self._known) * len(quotas) < KEPT_NUMBERS:
                self._known[low, high] = known
        return known

    def locate(self, sources: np.ndarray, units: np.ndarray) -> np.ndarray:
        """The shard of each unit: of the source's ``quotas[source]`` units, shards take consecutive ones."""
        shards = np.zeros(len(units), dtype=np.int64)
        nodes = [(0, self.shards, self.quotas, np.zeros_like(self.quotas), np.arange(len(units)))]
        while nodes:
            low, high, quotas, before, at = nodes.pop()
            if not len(at):
                continue
            if high - low == 1:
                shards[at] = low
                continue
            middle = (low + high) // 2
            left = self.split(quotas, low, middle, high)
            is_left = units[at] - before[sources[at]] < left[sources[at]]
            nodes.append((low, middle, left, before, at[is_left]))
            nodes.append((middle, high, quotas - left, before + left, at[~is_left]))
        return shards


def targets(sizes: list[int], weights: Iterable[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, where none exceeds ``max_copies`` times its size.

    Weights repeat along the list. The excess over a limit goes to the others by weight, until none is above.
    """
    weights = list(weights)
    own = [weights[i % len(weights)] for i in range(len(sizes))]
    found: list[float | None] = [None] * len(sizes)
    rest = float(sum(sizes))
    while True:
        free = [i for i, x in enumerate(found) if x is None]
        total = sum(own[i] for i in free)
        if not free or not total:
            return [x or 0.0 for x in found]
        above = [i for i in free if rest * own[i] / total > max_copies * sizes[i]]
        if not above:
            for i in free:
                found[i] = rest * own[i] / total
            return found
        for i in above:
            found[i] = float(max_copies * sizes[i])
        rest = float(sum(sizes)) - sum(x for x in found if x is not None)


def _word_count(texts: pd.Series) -> pd.Series:
    return pd.Series([len(t.split()) for t in texts], dtype="int64")


def sized(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the number of words that white space parts; 0 for a null text."""
    return docs.withColumn(name, F.pandas_udf(_word_count, "long")(text_bytes(F.col("text"))))


@dataclass
class Quotas:
    """Per source, in code point order with null last: its size, target, and what is drawn of it."""

    sources: list[str | None]
    rows: list[int]
    sizes: list[int]
    targets: list[float]

    @property
    def whole(self) -> list[int]:
        """Times that all of the source is taken."""
        return [int(t // s) if s else 0 for s, t in zip(self.sizes, self.targets, strict=True)]

    def blocks(self, block_words: int) -> list[int]:
        return [-(-s // block_words) for s in self.sizes]

    @property
    def partial(self) -> list[int]:
        """Words that are taken once more."""
        return [min(s, round(t - w * s)) for s, t, w in zip(self.sizes, self.targets, self.whole, strict=True)]


def quotas(slim: DataFrame, weights: Iterable[float], max_copies: int) -> Quotas:
    totals = slim.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = sorted(totals, key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in totals]
    return Quotas([r.source for r in totals], [r.rows for r in totals], sizes, targets(sizes, weights, max_copies))


def draws(
    docs: DataFrame,
    weights: Iterable[float] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``shards`` (where each of a row's copies goes) and ``kept``;
    with a text also ``short``, its first ``kept`` words.

    ``docs`` has ``doc_id``, ``source``, ``text`` or ``size``, and any other columns under other names. A source's rows
    are permuted by a hash of id and text (identical rows are alike) and laid end to end; a row belongs to the block
    that it starts in. Of each source all words are taken as often as they fit into the target, then the first words of
    the permutation make up the rest, to the word: of the row in which they end, the last copy has only ``kept`` words
    (null for all other rows). Copies of blocks are numbered, and each shard gets its own stretch of numbers. So no row is
    taken more than ``max_copies`` times, and a source meets its target up to rounding, however long its texts are. Rows
    of size 0 go with the place they stand at; a source without words gives none.
    """
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text") if "text" in docs.columns else F.col("order"), 1)
    rows = (docs if "size" in docs.columns else sized(docs, "size")).withColumn("order", hashed)
    slim = rows.select(F.col("source").cast("string").alias("source"), "order", "size")
    slim = slim if "text" not in docs.columns else checkpointed(slim)
    found = quotas(slim, weights, max_copies)
    spark = docs.sparkSession
    units = found.blocks(block_words)
    taken = [w * n - (-p // block_words) for w, n, p in zip(found.whole, units, found.partial, strict=True)]
    words = sum(found.targets)
    tree = Tree(np.array(taken or [0], dtype=np.int64), max(1, -(-int(words) // shard_words)), seed)
    shared = spark.sparkContext.broadcast((tree, *(np.array(x, dtype=np.int64) for x in (found.whole, units, found.partial))))

    # As an Arrow table, which reaches the executors without Python workers of its own.
    table = pa.table(
        {
            "rank": pa.array(range(len(found.sources)), pa.int32()),
            "named": pa.array(found.sources, pa.string()),
            "buckets": pa.array([max(1, n // BUCKET_ROWS) for n in found.rows], pa.int64()),
            "source_size": pa.array(found.sizes, pa.int64()),
            "target": pa.array(found.targets, pa.float64()),
            "partial": pa.array(found.partial, pa.int64()),
        }
    )
    sources = F.broadcast(spark.createDataFrame(table))

    def placed(df: DataFrame) -> DataFrame:
        bucket = (F.col("order") / F.lit(float(1 << 63)) * F.col("buckets")).cast("long")
        return df.join(sources, F.col("source").cast("string").eqNullSafe(F.col("named"))).withColumn("bucket", F.least(bucket, F.col("buckets") - 1))

    sums = placed(slim).groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("rank", "bucket", F.coalesce(before, F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))

    def copies(ranks: pd.Series, starts: pd.Series) -> pd.Series:
        tree, whole, units, partial = shared.value
        rank, at = ranks.to_numpy(), starts.to_numpy()
        if not len(rank):
            return pd.Series([], dtype=object)
        block = np.minimum(at // block_words, np.maximum(units[rank] - 1, 0))
        times = np.where(units[rank] > 0, whole[rank] + (at < partial[rank]), 0)
        row = np.repeat(np.arange(len(rank)), times)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        shards = tree.locate(rank[row], nth * units[rank[row]] + block[row])
        return pd.Series(np.split(shards, np.cumsum(times)[:-1]), dtype=object)

    ordered = placed(rows).join(starts, ["rank", "bucket"]).withColumn("start", start)
    shards = F.pandas_udf(copies, "array<long>")("rank", "start").alias("shards")
    rest = F.col("partial") - F.col("start")
    left = F.when((rest > 0) & (rest < F.col("size")), rest)
    names = [c for c in docs.columns if c not in ("order", "size")]
    # In one projection, so that one Python worker does both.
    short = [F.pandas_udf(_first_words, "string")(F.when(F.col("kept").isNotNull(), text_bytes(F.col("text"))), F.col("kept")).alias("short")]
    return ordered.withColumn("kept", left).select(*names, "size", "source_size", "target", "kept", shards, *(short if "text" in names else []))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _first_words(texts: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series(
        [None if t is None else t[: next(islice(_WORD.finditer(t), int(n) - 1, None)).end()].decode() for t, n in zip(texts, words, strict=True)],
        dtype=object,
    )


def mix(docs: DataFrame, cut: str | None = None, **options) -> DataFrame:
    """The mix: the columns of ``docs``, and ``shard`` and ``position`` (names lengthened if taken).

    A row for each copy. ``position`` counts within the shard, in an order drawn by a hash; a shard holds about
    ``shard_words`` words, so that order is local to it. One copy of one document of a source, at which its target is
    reached, has only its first words; a boolean column ``cut`` tells, if named.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "source", "text")}
    inner = docs.select(*("doc_id", "source", "text"), *(F.col(c).alias(n) for c, n in names.items()))
    placed = draws(inner, **options).withColumn("last", F.size("shards") - 1)
    found = placed.select(*inner.columns, "short", "last", F.posexplode("shards").alias("copy", "to"))
    is_cut = F.col("short").isNotNull() & (F.col("copy") == F.col("last"))
    shuffled = Window.partitionBy("to").orderBy(F.xxhash64("to", "copy", "doc_id", "text"), "doc_id", "copy")
    numbered = found.withColumn("nth", F.row_number().over(shuffled) - 1).withColumn("is_cut", is_cut)
    numbered = numbered.withColumn("text", F.when(F.col("is_cut"), F.col("short")).otherwise(F.col("text")))
    shard, position = unused_name(docs, "shard"), unused_name(docs, "position")
    told = [] if cut is None else [F.col("is_cut").alias(cut)]
    return numbered.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns), F.col("to").alias(shard), F.col("nth").alias(position), *told)


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row: ``taken`` counts the words of all its copies."""
    hashed = F.xxhash64(F.lit(options.get("seed", SEED)), "doc_id", "text").alias("order")
    slim = sized(docs.select("doc_id", "source", "text"), "size").select("doc_id", "source", "size", hashed)
    found = draws(checkpointed(slim), **options)
    taken = F.col("size") * F.size("shards") - F.coalesce(F.col("size") - F.col("kept"), F.lit(0))
    return found.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
