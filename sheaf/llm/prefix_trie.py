"""Prefix trie of conversations: a balanced-parentheses code per shard, whose shared spines are merged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.plans.staging import checkpointed

#: Conversations whose ids leave the same quotient share the first turns of the smallest such id.
FAMILY = 5
#: From 0 to so many, without the last, turns are shared; a hash of the id tells how many.
MAX_SHARED = 9
#: Turns of distinct conversations that one shard holds, where there are more than the shuffle's partitions make.
SHARD_TURNS = 1 << 20
#: Positions of one block of parentheses.
BLOCK = 64
#: Bytes of the hash that stands for a turn.
TURN_BYTES = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODES = "shard int, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"


class Parentheses:
    """A balanced sequence of parentheses, with the least and greatest excess of each block in a tree over the blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = max(1, -(-len(opens) // BLOCK))
        self.size = 1 << (blocks - 1).bit_length()
        padded = np.zeros(self.size * BLOCK, dtype=np.int64)
        padded[: len(opens)] = self.excess
        self.low, self.high = np.zeros(2 * self.size, dtype=np.int64), np.zeros(2 * self.size, dtype=np.int64)
        self.low[self.size :], self.high[self.size :] = padded.reshape(-1, BLOCK).min(axis=1), padded.reshape(-1, BLOCK).max(axis=1)
        level = self.size
        while level > 1:
            level //= 2
            self.low[level : 2 * level] = self.low[2 * level : 4 * level].reshape(-1, 2).min(axis=1)
            self.high[level : 2 * level] = self.high[2 * level : 4 * level].reshape(-1, 2).max(axis=1)
        #: How many leaf pairs, an opening and at once its closing one, stand before each position.
        self.leaf_pairs = np.zeros(len(opens) + 1, dtype=np.int64)
        np.cumsum(opens[:-1] & ~opens[1:], out=self.leaf_pairs[1:-1])
        self.leaf_pairs[-1:] = self.leaf_pairs[-2:-1]

    def _scan(self, start: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first position from ``start`` to the end of its block with that excess, or -1."""
        found = np.full(len(start), -1, dtype=np.int64)
        left, at = np.arange(len(start)), start
        while len(left):
            hit = self.excess[at] == goal[left]
            found[left[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at % BLOCK != 0) & (at < len(self.excess))
            left, at = left[more], at[more]
        return found

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: where the excess first falls below its own."""
        goal = self.excess[at] - 1
        found = self._scan(at + 1, goal)
        left = np.flatnonzero(found < 0)
        node, goal = (at[left] + 1) // BLOCK + self.size, goal[left]
        climbing = np.arange(len(left))
        while len(climbing):  # up to the first right-hand neighbour that goes as low
            here = node[climbing]
            beside = here + 1
            hit = here % 2 == 0
            hit[hit] = (self.low[beside[hit]] <= goal[climbing[hit]]) & (goal[climbing[hit]] <= self.high[beside[hit]])
            node[climbing] = np.where(hit, beside, here // 2)
            climbing = climbing[~hit]
        sinking = np.flatnonzero(node < self.size)
        while len(sinking):  # and down to its first block that does
            below = 2 * node[sinking]
            node[sinking] = below + (self.low[below] > goal[sinking])
            sinking = sinking[node[sinking] < self.size]
        found[left] = self._scan((node - self.size) * BLOCK, goal)
        return found


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, end to end."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value from ``first`` to ``last``, both included."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    found = np.empty(len(first), dtype=np.int64)
    for k, row in enumerate(table):
        at = np.flatnonzero(level == k)
        found[at] = np.minimum(row[first[at]], row[last[at] - (1 << k) + 1])
    return found


def _common_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns at the start of two paths that are equal; -1 if one path is none."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // TURN_BYTES
    differs = (np.frombuffer(a, dtype="V16", count=n) != np.frombuffer(b, dtype="V16", count=n)) if n else np.zeros(0, dtype=bool)
    return int(differs.argmax()) if differs.any() else n


def _prefix_keys(path: bytes, depth: int) -> list[str]:
    """A key for each prefix of a path from the empty one to that of ``depth`` turns."""
    digest = hashlib.md5(b"", usedforsecurity=False)
    keys = [digest.hexdigest()]
    for k in range(depth):
        digest.update(path[k * TURN_BYTES : (k + 1) * TURN_BYTES])
        keys.append(digest.copy().hexdigest())
    return keys


def shard_nodes(paths: list[bytes], sizes: np.ndarray, counts: np.ndarray, first_ids: np.ndarray, ends: list[str], before: bytes | None, after: bytes | None) -> dict[str, np.ndarray | list]:
    """The nodes of one shard in preorder, from its paths: distinct, ascending, each a sequence of turns' hashes.

    ``sizes``: bytes of all turns end to end; ``counts``, ``first_ids`` and ``ends`` belong to the paths. ``before``
    and ``after`` are the neighbouring paths in other shards. A node that they pass through has a ``key``, and its
    numbers tell only this shard's part, to be added up: each node counts as opened in one shard.
    """
    n = np.array([len(p) // TURN_BYTES for p in paths], dtype=np.int64)
    starts = np.cumsum(n) - n
    turns = np.frombuffer(b"".join(paths), dtype="<u8").reshape(-1, 2)
    # Turns that each path has in common with the one before it.
    both = np.minimum(n[1:], n[:-1])
    at, place = _ranges(starts[1:], both), _ranges(np.zeros_like(both), both)
    equal = (turns[at] == turns[np.repeat(starts[:-1], both) + place]).all(axis=1)
    common = both.copy()
    np.minimum.at(common, np.repeat(np.arange(len(both)), both)[~equal], place[~equal])
    joined, left_out = _common_turns(before, paths[0]), _common_turns(paths[-1], after)

    opened = n - np.concatenate([[-1], common])
    closed = n - np.concatenate([common, [-1]])
    code = Parentheses(np.repeat(np.tile([True, False], len(n)), np.stack([opened, closed], axis=1).ravel()))
    opens = np.flatnonzero(code.opens)
    closes = code.find_close(opens)
    nodes = np.arange(len(opens))
    depth = _ranges(n - opened + 1, opened)
    path_of = np.repeat(np.arange(len(n)), opened)
    first_node = np.cumsum(opened) - opened
    last_path = np.searchsorted(opens[first_node], closes) - 1

    # A path leaves the one before it at a node that is still open.
    parent, line = nodes - 1, list(range(opened[0]))
    for k, turns_kept, size in zip(first_node[1:].tolist(), common.tolist(), opened[1:].tolist(), strict=True):
        del line[turns_kept + 1 :]
        parent[k] = line[-1]
        line.extend(range(k, k + size))
    shared = np.zeros(len(nodes), dtype=bool)
    shared[: joined + 1] = True
    here = ~shared
    shared[line[: left_out + 1]] = True

    n_convs = np.concatenate([[0], np.cumsum(counts)])
    n_convs = n_convs[last_path + 1] - n_convs[path_of]
    last_bytes = np.where(depth > 0, np.concatenate([[0], sizes])[starts[path_of] + depth], 0)
    saved = np.concatenate([[0], np.cumsum((n_convs - here) * last_bytes)])
    leaves = code.leaf_pairs[closes] - code.leaf_pairs[opens]
    if left_out == n[-1]:  # the last leaf has children in the next shard
        leaves[line] -= 1
    key, parent_key = [None] * len(nodes), [None] * len(nodes)
    for path, way, depths in ((paths[0], range(joined + 1), joined), (paths[-1], line[: left_out + 1], left_out)):
        for k, name in zip(way, _prefix_keys(path, depths), strict=False):
            key[k] = name
    for k in np.flatnonzero(np.where(parent >= 0, shared[parent], False)).tolist():
        parent_key[k] = key[parent[k]]
    first_id = _range_minima(first_ids, path_of, last_path)
    end = [None] * len(nodes)
    for k, digest in zip((first_node + opened - 1).tolist(), ends, strict=True):
        end[k] = digest
    return {
        "key": key,
        "parent_key": parent_key,
        "conv_id": first_id,
        "depth": depth,
        "parent_conv_id": pd.array(np.where(parent >= 0, first_id[parent], 0), dtype="Int64"),
        "n_convs": n_convs,
        "n_children": np.bincount(parent[here & (parent >= 0)], minlength=len(nodes)),
        "n_leaves": leaves,
        "saved_tokens": saved[nodes + (closes - opens + 1) // 2] - saved[nodes],
        "ends": end,
    }


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MAX_SHARED).cast("int")


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, path, sizes)`` for each conversation: the hashes of its turns after rebuilding, and their texts' bytes.

    Turns are ordered by ``turn`` (nulls first), then by the hash of role and text. Rows with a null ``conv_id`` are no
    conversation's; a null role or text is empty. Texts aren't shuffled, only their hashes.
    """
    role, words = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn"), F.md5(F.concat_ws(":", F.octet_length(role), role, words).cast("binary")).alias("hash"), F.octet_length(words).cast("long").alias("bytes"))
    slim = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    # In ascending arrays a null turn comes first, as nulls are the smallest values.
    own = checkpointed(slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")))
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, MAX_SHARED - 1).alias("head"))
    joined = own.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "head_id", "left")
    n = shared_turns(F.col("conv_id"))
    kept = F.slice("turns", n + 1, F.greatest(F.size("turns"), F.lit(1)))
    borrowed = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), n))
    whole = joined.select("conv_id", F.when(borrowed.isNull(), kept).otherwise(F.concat(borrowed, kept)).alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["hash"]), ""))
    return whole.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of equal conversations, comma-joined, for each run of them within a batch."""
    for batch in batches:
        names, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)] if names else [0]
        runs = list(zip(edges, edges[1:], strict=False))
        texts = [",".join(map(str, ids[i:j].tolist())) for i, j in runs]
        arrays = [pa.array([names[i] for i, _ in runs], pa.string()), pa.array([ids[i] for i, _ in runs], pa.int64()), pa.array([j - i for i, j in runs], pa.int64()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["same", "first_id", "n", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each set of equal conversations; the pieces of its ids follow each other and are hashed as they come."""
    names = ["same", "conv_id", "n", "ends"]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    same, first_id, n, digest = None, 0, 0, hashlib.sha256()
    for batch in batches:
        done = []
        for name, low, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != same:
                if same is not None:
                    done.append((same, first_id, n, digest.hexdigest()))
                same, first_id, n, digest = name, low, 0, hashlib.sha256()
            else:
                digest.update(b",")
            n += count
            digest.update(ids.encode())
        yield rows(done)
    if same is not None:
        yield rows([(same, first_id, n, digest.hexdigest())])


def distinct_conversations(rebuilt: DataFrame) -> DataFrame:
    """``(conv_id, path, sizes, n, ends)``: equal conversations as one, with the smallest id and the hash of all ids.

    Ids are put in order by ranges of (conversation, id), so a large group of copies is joined by many tasks; the hash
    itself runs over the pieces, a row for each some thousand ids, without gathering them.
    """
    ids = rebuilt.select(F.md5("path").alias("same"), "conv_id")
    pieces = ids.repartitionByRange("same", "conv_id").sortWithinPartitions("same", "conv_id").mapInArrow(_joined_ids, "same string, first_id long, n long, ids string")
    found = pieces.repartition("same").sortWithinPartitions("same", "first_id").mapInArrow(_digests, "same string, conv_id long, n long, ends string")
    return rebuilt.join(found.select("conv_id", "n", "ends"), "conv_id")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations: ``(conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)``.

    A conversation borrows its first turns from the first of its family. Each distinct sequence of first turns is a
    node, from the empty one on; its members are the conversations that start with it, its ``conv_id`` the smallest
    of them. ``saved_tokens`` adds up, over the subtree, the bytes of each node's last text times the members after
    the first; ``ends_sha256`` is the hash of the members that end there. A turnless conversation ends at the root.
    Equal turns of a conversation count each time. An empty table has no members, hence no root.

    Distinct conversations are put in order by their turns' hashes and cut into shards of consecutive ones. Each shard
    writes its trie as balanced parentheses and reads all numbers from them. Nodes on the way to a neighbouring
    shard's first or last conversation are merged by adding up; all others are complete. A conversation's turns are
    one array of hashes (24 bytes a turn); longer ones than a task can hold would need another form.
    """
    rebuilt = checkpointed(rebuilt_conversations(conversations))
    distinct = checkpointed(distinct_conversations(rebuilt))
    total = distinct.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = distinct.repartitionByRange(max(partitions, -(-total // SHARD_TURNS)), "path")
    shards = checkpointed(shards.withColumn("shard", F.spark_partition_id()))
    # One row a shard, whatever it holds.
    order = Window.orderBy("shard")
    edges = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    edges = edges.select("shard", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))

    def encode(shard: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("path", kind="stable")
        found = shard_nodes(
            shard["path"].tolist(),
            np.concatenate([np.asarray(x, dtype=np.int64) for x in shard["sizes"]]),
            shard["n"].to_numpy(),
            shard["conv_id"].to_numpy(),
            shard["ends"].tolist(),
            *edge[["before", "after"]].iloc[0],
        )
        number = int(shard["shard"].iloc[0])
        return pd.DataFrame({"shard": np.full(len(found["key"]), number, dtype=np.int32)} | found)

    found = checkpointed(shards.groupBy("shard").cogroup(edges.groupBy("shard")).applyInPandas(encode, NODES))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    spines = found.where("key IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = checkpointed(spines.groupBy("key", "parent_key", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends")))
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    # Children of a merged node are named shard by shard: the root alone has children in all of them.
    ways = spines.select("shard", F.col("key").alias("parent_key")).join(named, "parent_key")
    complete = found.where("key IS NULL")
    root = complete.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    inner = complete.where("depth > 0 AND parent_key IS NULL")
    outer = complete.where("parent_key IS NOT NULL").drop("parent_conv_id").join(ways, ["shard", "parent_key"])
    top = merged.join(named, "parent_key", "left")
    nodes = root.select(*columns).union(inner.select(*columns)).union(outer.select(*columns)).union(top.select(*columns))
    return nodes.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")
