"""Embedding near-duplicates: vectors meet in spherical caps, whose directions form a random product code."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.components import connected_components
from sheaf.plans.staging import checkpointed

MIN_COSINE = 0.9
#: Directions are all combinations of one code word per half of the rotated vector.
CODE_WORDS = 256
#: A vector belongs to the caps whose direction's inner product exceeds this, in units of 1 / sqrt(dimension).
THRESHOLD = 3.5
#: A vector in fewer caps than this goes to so many of its nearest directions.
LEAST_CAPS = 12
#: Vectors of one cap that are compared at once; a larger cap is cut by a hash, and each two parts are compared.
PART_ROWS = 1024
SEED = 23


@dataclass
class Code:
    """A rotation, and the code words of both halves, for vectors of one dimension."""

    rotation: np.ndarray
    words: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, dimension: int, size: int = CODE_WORDS) -> Code:
        rng = np.random.default_rng([SEED, dimension])
        rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
        half = dimension // 2
        words = []
        for width in (half, dimension - half):
            # A line has two directions, and spaces of few dimensions no use for many.
            drawn = rng.normal(size=(min(size, 4**width), width)) if width != 1 else np.array([[1.0], [-1.0]])
            # Both halves of a direction have the length that makes the whole a unit vector.
            words.append(drawn / np.maximum(np.linalg.norm(drawn, axis=1, keepdims=True), 1e-12) * (width / dimension) ** 0.5)
        return cls(rotation, (words[0], words[1]))

    def caps(self, vectors: np.ndarray, threshold: float = THRESHOLD, least: int = LEAST_CAPS) -> list[np.ndarray]:
        """For each unit vector the directions beyond the threshold, ascending.

        The scores of one half are sorted, so for each word of the other half those that reach the threshold with it
        are a prefix; words that reach it with none are passed over.
        """
        turned = vectors @ self.rotation
        half, size = self.words[0].shape[1], len(self.words[1])
        first, second = turned[:, :half] @ self.words[0].T, turned[:, half:] @ self.words[1].T
        order = np.argsort(-second, axis=1, kind="stable")
        falling = -np.take_along_axis(second, order, axis=1)
        limit = threshold / vectors.shape[1] ** 0.5
        found = []
        for a, down, by in zip(first, falling, order, strict=True):
            needed = limit
            while True:
                near = np.flatnonzero(a - down[0] >= needed)
                counts = np.searchsorted(down, a[near] - needed, side="right")
                total = int(counts.sum())
                if total >= min(least, len(self.words[0]) * size):
                    break
                needed -= 0.1 / vectors.shape[1] ** 0.5
            steps = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
            found.append(np.sort(np.repeat(near, counts) * size + by[steps]).astype(np.int32))
        return found


def usable(vector: list | np.ndarray | None) -> np.ndarray | None:
    """The vector in double precision; None if it is null, empty, zero, or has a null or non-finite component."""
    if vector is None or len(vector) == 0:
        return None
    try:
        found = np.asarray(vector, dtype=np.float64)
    except (TypeError, ValueError):
        return None
    return found if np.isfinite(found).all() and found.any() else None


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _read(kind: np.dtype):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for value in batch.column(1):
                vector = usable(value.as_py())
                packed.append(None if vector is None else (vector + 0.0).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["vec_id", "vector"])

    return read


def _unpacked(packed: list[bytes], kind: np.dtype) -> np.ndarray:
    return unit(np.stack([np.frombuffer(p, dtype=kind) for p in packed]).astype(np.float64))


def memberships(classes: DataFrame, kind: np.dtype, threshold: float, code_words: int) -> DataFrame:
    """``classes`` (class, copies, vector) with ``caps``: the caps of each vector, among those of its dimension."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            packed = batch.column(2).to_pylist()
            caps: list[np.ndarray | None] = [None] * len(packed)
            sizes = np.array([len(p) // kind.itemsize for p in packed])
            for size in np.unique(sizes):
                if size not in codes:
                    codes[size] = Code.of(int(size), code_words)
                at = np.flatnonzero(sizes == size)
                for i, found in zip(at, codes[size].caps(_unpacked([packed[i] for i in at], kind), threshold), strict=True):
                    caps[i] = found
            arrays = [*batch.columns, pa.array(caps, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["class", "copies", "vector", "caps"])

    return classes.mapInArrow(decode, "class long, copies long, vector binary, caps array<int>")


@dataclass
class Group:
    """Vectors that meet in one cap: those of one part, or of two."""

    cap: int
    classes: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    caps: list[np.ndarray]
    parts: np.ndarray

    def links(self, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """For each vector: how many others link that no earlier cap has counted, and the smallest class of its component."""
        cosines = self.vectors @ self.vectors.T
        close = np.triu(cosines >= min_cosine, 1)
        if len(np.unique(self.parts)) > 1:  # the pairs within a part are another group's
            close &= self.parts[:, None] != self.parts[None]
        a, b = np.nonzero(close)
        label = self.classes.copy()
        while len(a):
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            if (label == before).all():
                break
        fresh = ~self._met_before(a, b)
        counts = np.bincount(a[fresh], self.copies[b[fresh]], len(label)) + np.bincount(b[fresh], self.copies[a[fresh]], len(label))
        return counts.astype(np.int64), label

    def _met_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair shares a cap of a smaller number: there it was counted."""
        if not len(a):
            return np.zeros(0, dtype=bool)
        rows = np.unique(np.concatenate([a, b]))
        earlier = [self.caps[i][self.caps[i] < self.cap] for i in rows]
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in earlier])
        caps, place, times = np.unique(np.concatenate(earlier), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        table = np.zeros((len(rows), int((times > 1).sum())), dtype=np.float32)
        used = times[place] > 1
        table[owner[used], shared[place[used]]] = 1
        met = (table @ table.T) > 0
        return met[np.searchsorted(rows, a), np.searchsorted(rows, b)]


def _groups(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[Group]:
    """Consecutive rows with equal cap, size and parts; rows arrive sorted by these."""
    key, rows = None, []

    def built() -> Group:
        vectors = _unpacked([r["vector"] for r in rows], kind)
        return Group(key[1], np.array([r["class"] for r in rows]), np.array([r["copies"] for r in rows]), vectors, [np.array(r["caps"]) for r in rows], np.array([r["part"] for r in rows]))

    for batch in batches:
        for row in batch.to_pylist():
            now = (row["size"], row["cap"], row["low"], row["high"])
            if now != key:
                if len(rows) > 1:
                    yield built()
                key, rows = now, []
            rows.append(row)
    if len(rows) > 1:
        yield built()


def _compare(min_cosine: float, kind: np.dtype):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, kind):
            counts, label = group.links(min_cosine)
            linked = (counts > 0) | (label != group.classes)
            if linked.any():
                arrays = [pa.array(x[linked], pa.int64()) for x in (group.classes, counts, label)]
                yield pa.RecordBatch.from_arrays(arrays, names=["class", "links", "component"])

    return compare


def near_duplicates(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    threshold: float = THRESHOLD,
    code_words: int = CODE_WORDS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors`` (``vec_id``, ``embedding``).

    Equal vectors are copies of one class and link at once. Classes meet in the caps they share, among vectors of
    equal dimension, and every pair there is verified by its cosine in double precision; a pair that shares several
    caps is counted in the first. All links found are real; a pair at the limit is missed if it shares no cap (see
    the README for measured recall). A cap is never gathered: above ``part_rows`` vectors it is cut into parts, and
    each two parts are a group of their own. Only counts and component labels leave a group, never its pairs.
    With more vectors, raise ``code_words`` and ``threshold`` together: caps then stay as full as they are.

    Vectors that are null, empty, zero, or hold null or non-finite components have no links and are their own
    component. Repeated rows are copies of each other; a null ``vec_id`` links and is never a component's id unless
    all are null (then null, and ``kept`` is true). ``class`` is a 64-bit hash of the vector.
    """
    # Single-precision vectors stay so on the way; all arithmetic is in double precision.
    kind = np.dtype("f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "f8")
    slim = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_read(kind), "vec_id long, vector binary")
    rows = checkpointed(slim.withColumn("class", F.xxhash64("vector")))
    good = rows.where("vector IS NOT NULL")
    classes = good.groupBy("class", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    known = checkpointed(memberships(classes.select("class", "copies", "vector"), kind, threshold, code_words))
    placed = known.select("class", (F.octet_length("vector") / kind.itemsize).cast("int").alias("size"), F.explode("caps").alias("cap"))
    crowded = placed.groupBy("size", "cap").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    parts = F.ceil(F.col("rows") / part_rows).cast("int")
    member = (
        known.select("class", "copies", "vector", "caps", (F.octet_length("vector") / kind.itemsize).cast("int").alias("size"), F.explode("caps").alias("cap"))
        .join(crowded.select("size", "cap", parts.alias("parts")), ["size", "cap"])
        .withColumn("part", F.pmod(F.xxhash64("class", F.lit("part")), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("part", "other"))
        .withColumn("high", F.greatest("part", "other"))
    )
    sorted_rows = member.repartition("size", "cap", "low", "high").sortWithinPartitions("size", "cap", "low", "high")
    found = sorted_rows.select("size", "cap", "low", "high", "part", "class", "copies", "vector", "caps").mapInArrow(
        _compare(min_cosine, kind), "class long, links long, component long"
    )
    found = checkpointed(found)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    stars = connected_components(found.select("class", "component")).select(F.col("node").alias("class"), "component")
    homes = classes.select("class", "copies", "first_id").join(stars, "class", "left").withColumn("component", F.coalesce("component", "class"))
    lowest = homes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = homes.join(lowest, "component").join(links, "class", "left").select(
        F.col("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    result = good.join(named, "class").select("vec_id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
