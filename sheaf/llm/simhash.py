"""SimHash near-duplicates: fingerprints of word shingles, joined on blocks that close pairs share."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.components import connected_components
from sheaf.llm.text import CHUNK_BYTES, text_bytes, unused_name
from sheaf.plans.staging import checkpointed

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints that share a block key. Up to so many, each is compared with each; more meet at common neighbours.
LARGE_BUCKET = 1000


def _set_bits(shingles: list[bytes]) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=len(shingles))
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of one text; a long text is hashed part by part."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        counts, total = _set_bits([b" ".join(words)]), 1
    else:
        total, counts = len(words) - shingle_words + 1, np.zeros(64, dtype=np.int64)
        for start in range(0, total, CHUNK_BYTES):
            part = words[start : start + CHUNK_BYTES + shingle_words - 1]
            counts += _set_bits(list(map(b" ".join, zip(*(part[k:] for k in range(shingle_words)), strict=False))))
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, key: Column | None = None) -> DataFrame:
    """``(doc_id, bits)`` for each row of ``docs``: bit i is set if it is in over half the shingles' XXH64.

    A null or blank text has fingerprint zero. ``key``: a column of longs to hand on as ``key``.
    """
    kept = ["doc_id"] if key is None else ["doc_id", "key"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(text.as_py(), shingle_words) for text in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(bits, pa.int64())], names=[*kept, "bits"])

    keys = [] if key is None else [key.alias("key")]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, text_bytes(F.col("text")))
    return slim.mapInArrow(hashed, ", ".join(f"{name} long" for name in [*kept, "bits"]))


def _blocks(max_bits: int) -> list[int]:
    """Masks over 64 bits: any two numbers that differ in at most ``max_bits`` bits agree under one of them.

    The bits are cut into ``max_bits + 2`` blocks, of which two at least stay equal; a mask covers two blocks.
    """
    edges = [round(64 * i / (max_bits + 2)) for i in range(max_bits + 3)]
    blocks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, max_bits: int = MAX_BITS, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """Edges ``(a, b)`` among distinct fingerprints ``bits``: the same components as all pairs within ``max_bits``.

    Fingerprints join on each mask's bits, and a pair counts if its Hamming distance holds. A bucket above
    ``large_bucket`` isn't paired (``max_bits`` 2): two fingerprints differ in at most two bits just if some number
    is at most one bit away from both. So each goes to the numbers one bit away within the bucket, and those that
    meet are linked to the smallest of them. Both ways are exact.
    """
    if max_bits < 0:
        raise ValueError("max_bits is negative")
    masks = _blocks(max_bits)
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("mask"), F.col("bits").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks))))
    keyed = distinct.select("bits", keys.alias("at")).select("bits", "at.mask", "at.key")
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("size"), F.min("bits").alias("low")).where("size > 1")
    bucketed = checkpointed(keyed.join(sizes.drop("low"), ["mask", "key"]))
    small = bucketed.where(F.col("size") <= large_bucket) if max_bits == 2 else bucketed
    paired = (
        small.select("mask", "key", F.col("bits").alias("a"))
        .join(small.select("mask", "key", F.col("bits").alias("b")), ["mask", "key"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
        .select("a", "b")
    )
    if max_bits != 2:
        return paired
    free = F.element_at(F.array(*(F.array(*(F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1)) for m in masks)), F.col("mask") + 1)
    near = F.explode(F.concat(F.array(F.lit(0).cast("long")), free))
    met = bucketed.where(F.col("size") > large_bucket).select("mask", "key", "bits", near.alias("flip"))
    met = met.select("mask", "key", "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("hub"))
    lowest = met.groupBy("mask", "key", "hub").agg(F.min("bits").alias("low"))
    starred = met.join(lowest, ["mask", "key", "hub"]).where("bits != low").select(F.col("low").alias("a"), F.col("bits").alias("b"))
    return paired.union(starred)


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, bits, component_id)`` for each row of ``docs``.

    Rows link if their fingerprints differ in ``max_bits`` bits or fewer, equal ones included; ``component_id`` is
    the smallest non-null ``doc_id`` reachable (null if all are null). Repeated rows and repeated ids are rows like
    any other; null and blank texts have fingerprint zero and link with it. Copies are first reduced to one
    fingerprint, so a group of copies of any size costs one row in the search.
    """
    marked = checkpointed(fingerprints(docs, shingle_words))
    return marked.join(_components(marked, max_bits), "bits").select("doc_id", "bits", "component_id")


def _components(marked: DataFrame, max_bits: int) -> DataFrame:
    """``(bits, component, component_id)`` for each fingerprint: its component's smallest one, and smallest id.

    Written, so that the join with a large group of copies, all of one fingerprint, can be split.
    """
    classes = marked.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    stars = connected_components(links(classes.select("bits"), max_bits)).select(F.col("node").alias("bits"), "component")
    homes = classes.join(stars, "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    lowest = homes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return checkpointed(homes.join(lowest, "component").select("bits", "component", "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Of each component one row with the smallest id, with all its columns.

    Rows are judged by their own text: of several that carry one id, each stays that no other component's row nor a
    smaller id makes a near-duplicate; of those in one component the smallest row, by text, then by all its columns.
    Rows with a null id can't be named and stay. An empty table stays empty.
    """
    key, rank = unused_name(docs, "text_key"), unused_name(docs, "rank")
    component = unused_name(docs, "component")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    # Fingerprints by id and text: what follows needs the texts no more, but to hand them on.
    marked = checkpointed(fingerprints(docs, shingle_words, F.xxhash64("text")))
    found = marked.join(_components(marked, max_bits), "bits").where("doc_id IS NOT NULL").select(F.col("doc_id"), F.col("key").alias(key), F.col("component").alias(component), "component_id")
    gone = checkpointed(found.where("doc_id != component_id").select("doc_id", key).distinct())
    kept = keyed.where("doc_id IS NOT NULL").join(gone, ["doc_id", key], "left_anti")
    # Only where an id has several rows left is there something to choose.
    left = found.where("doc_id = component_id")
    several = checkpointed(left.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    homes = left.join(several, "doc_id", "left_semi").select("doc_id", key, component).distinct()
    order = [*(["text"] if "text" in docs.columns else []), F.to_json(F.struct(*docs.columns))]
    first = F.row_number().over(Window.partitionBy("doc_id", component).orderBy(*order))
    chosen = kept.join(homes, ["doc_id", key]).withColumn(rank, first).where(F.col(rank) == 1)
    single = kept.join(several, "doc_id", "left_anti")
    return single.select(*docs.columns).union(chosen.select(*docs.columns)).union(docs.where("doc_id IS NULL"))
