"""LM scoring: a gated recurrent language model with a class-factored softmax over an open vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.recurrent import Adagrad, Columns, forward_words, word_table
from sheaf.llm.text import SPACED, doc_hash, text_bytes, word_hashes
from sheaf.plans.staging import checkpointed

#: Words that the network tells apart; all others are the tail class, within which counts decide.
HEAD_WORDS = 4096
CLASSES = 64
#: Words whose counts every task gets; the counts of rarer ones are joined.
FREQUENT_WORDS = 1 << 18
WIDTH, DEPTH = 32, 24
#: Steps between two cuts of back-propagation, and sequences side by side, in training and in scoring.
WINDOW, SEQUENCES, SCORED = 16, 192, 384
#: States that wait for their softmax, in scoring.
HELD = 8192
#: Tokens of a task's texts that are scored together, so that many sequences go side by side, and that are counted together.
POOLED, COUNTED = 1 << 22, 1 << 21
#: A round trains shards of about so many tokens from the same start, and averages their weights.
SHARD_TOKENS, ROUNDS = 300_000, 3
#: A training text is learned from in pieces of so many tokens.
PIECE = 512
RATE = 0.06
BLOCK = 1024
SEED = 31
#: The hash that stands for the end of a text.
END = np.uint64(1)


@dataclass
class Vocabulary:
    """Counts of the frequent words by hash, and the classes of the head; ``tokens`` and ``types`` of the training texts."""

    hashes: np.ndarray
    counts: np.ndarray
    head: np.ndarray  # of each frequent word its number in the head, or the size of the head
    head_counts: np.ndarray
    bounds: np.ndarray  # classes are ranges of the head's numbers
    tokens: int
    types: int

    @property
    def size(self) -> int:
        return len(self.head_counts)

    @property
    def end(self) -> int:
        return int(self.head[np.searchsorted(self.hashes, END)])

    @property
    def tail_mass(self) -> float:
        """Smoothed count of all words beyond the head, one unseen word among them."""
        return float(self.tokens - self.head_counts.sum() + 0.5 * (self.types - (self.head_counts > 0).sum()) + 0.5)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words (-1: not there) and number in the head of each word."""
        shift, starts, bounded, numbers = self._table
        place = starts.take(hashes >> shift)
        # Hashes are spread evenly, so a word stands at or just behind the first place with its leading bits.
        below = np.flatnonzero(bounded.take(place) < hashes)
        while len(below):
            place[below] += 1
            below = below[bounded.take(place[below]) < hashes[below]]
        known = (bounded.take(place) == hashes) & (place < len(self.hashes))
        return np.where(known, place, -1), np.where(known, numbers.take(place), self.size)

    @cached_property
    def _table(self) -> tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]:
        """Bits to drop for the leading ones, first place with each of these, and hashes and numbers with one more at the end."""
        bits = len(self.hashes).bit_length() + 2
        shift = np.uint64(64 - bits)
        starts = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << shift)
        return shift, starts, np.append(self.hashes, np.uint64((1 << 64) - 1)), np.append(self.head, self.size)


def build_vocabulary(hashes: np.ndarray, counts: np.ndarray, tokens: int, types: int, head_words: int = HEAD_WORDS, classes: int = CLASSES) -> Vocabulary:
    """The head: the most frequent words and the end. Classes cut it, by falling count, into parts of about equal mass."""
    if END not in hashes:
        hashes, counts = np.append(hashes, END), np.append(counts, 0)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    ranked = np.lexsort((hashes, -counts))
    chosen = ranked[:head_words]
    at_end = int(np.searchsorted(hashes, END))
    if at_end not in chosen:
        chosen[-1] = at_end
    head = np.full(len(hashes), len(chosen), dtype=np.int64)
    head[chosen] = np.arange(len(chosen))
    # Roots of counts, as classes of equal mass would put one word in each of the first and thousands in the last.
    mass = np.cumsum(np.sqrt(counts[chosen] + 0.5))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes)
    bounds = np.unique(np.concatenate([[0], cuts, [len(chosen)]]))
    return Vocabulary(hashes, counts, head, counts[chosen], bounds, tokens, types)


Weights = dict[str, np.ndarray]


def new_weights(vocabulary: Vocabulary) -> Weights:
    """The model starts as the smoothed unigram model: the biases, the last column of ``classes`` and ``words``, hold it."""
    rng = np.random.default_rng(SEED)
    size, classes = vocabulary.size, len(vocabulary.bounds) - 1
    counts = vocabulary.head_counts + 0.5
    mass = np.append(np.add.reduceat(counts, vocabulary.bounds[:-1]), vocabulary.tail_mass)
    drawn = lambda *shape: (rng.normal(0, 1, shape) * shape[0] ** -0.5).astype(np.float32)
    with_bias = lambda shape, bias: np.concatenate([np.zeros(shape), bias[:, None]], axis=1).astype(np.float32)
    return {
        "embed": (rng.normal(0, 0.5, (size + 1, DEPTH))).astype(np.float32),
        "into": drawn(DEPTH, 3 * WIDTH),
        "into_bias": np.zeros(3 * WIDTH, dtype=np.float32),
        "recur": drawn(WIDTH, 3 * WIDTH),
        "classes": with_bias((classes + 1, WIDTH), np.log(mass / mass.sum())),
        "words": with_bias((size, WIDTH), np.log(counts)),
    }


#: Logits beyond this are shifted before their exponentials are taken in single precision.
SAFE = 60


class _Softmax:
    """Logits and probabilities of the targets' classes, and of the words of each one's class.

    Targets go by class, the tail's last (``order``), so that each class is a slice. ``classes`` has a row for each
    target. The logits of all classes' words stand one after the other in one array; each target of the head has
    ``sizes`` of them from ``starts``.
    """

    def __init__(self, states: np.ndarray, targets: np.ndarray, w: Weights, bounds: np.ndarray):
        """``states`` (rows, width + 1) end with a one, for the biases; rows with a target of -1 count for nothing."""
        self.order = np.flatnonzero(targets >= 0)
        found = np.repeat(np.arange(len(bounds), dtype=np.uint16), np.append(np.diff(bounds), 1))[targets[self.order]]
        by_class = np.argsort(found, kind="stable")
        self.order, self.found = self.order[by_class], found[by_class]
        self.rows, targets, self.states = len(targets), targets[self.order], states.take(self.order, axis=0)
        edges = np.searchsorted(self.found, np.arange(len(bounds)))
        counts, sizes = np.diff(edges), np.diff(bounds)
        ends = np.cumsum(counts * sizes)
        self.sizes = np.repeat(sizes, counts)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places = self.starts + targets[: edges[-1]] - np.repeat(bounds[:-1], counts)
        self.classes = self.states @ w["classes"].T
        self.words = np.empty(int(ends[-1]), dtype=np.float32)
        rows = zip(edges[:-1].tolist(), edges[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), ends.tolist(), strict=True)
        #: Of each class its targets, its words and their logits.
        self.groups = [
            (slice(start, stop), slice(low, high), self.words[end - (stop - start) * (high - low) : end].reshape(stop - start, high - low))
            for start, stop, low, high, end in rows
            if start < stop
        ]
        for at, own, logits in self.groups:
            np.matmul(self.states[at], w["words"][own].T, out=logits)
        self._shift()

    def _shift(self) -> None:
        if max(self.classes.max(initial=0), -self.classes.min(initial=0)) > SAFE:
            self.classes -= self.classes.max(axis=1, keepdims=True)
        if max(self.words.max(initial=0), -self.words.min(initial=0)) > SAFE:
            self.words -= np.repeat(np.maximum.reduceat(self.words, self.starts), self.sizes)

    def _exponentials(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the exponentials, which replace the logits."""
        np.exp(self.classes, out=self.classes)
        np.exp(self.words, out=self.words)
        inner = np.add.reduceat(self.words, self.starts) if len(self.starts) else np.zeros(0, dtype=np.float32)
        return self.classes @ np.ones(self.classes.shape[1], dtype=np.float32), inner

    def log_likelihoods(self) -> np.ndarray:
        """Natural log of the probability of each row's target; logits are used up."""
        part = self.classes[np.arange(len(self.found)), self.found].astype(np.float64)
        head = self.words[self.places]
        sums, inner = self._exponentials()
        part -= np.log(sums)
        part[: len(head)] += head - np.log(inner)
        result = np.zeros(self.rows)
        result[self.order] = part
        return result

    def gradients(self, w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean loss by each row's state, by the classes and by the words; logits are used up."""
        n = np.float32(max(1, len(self.found)) ** -1)
        sums, inner = self._exponentials()
        self.classes *= (n / sums)[:, None]
        self.classes[np.arange(len(self.found)), self.found] -= n
        self.words *= np.repeat(n / inner, self.sizes)
        self.words[self.places] -= n
        # After the targets' a row of zeros, for rows without a target.
        back, of_head = np.zeros((len(self.found) + 1, WIDTH), dtype=np.float32), np.empty((len(self.sizes), WIDTH), dtype=np.float32)
        np.matmul(self.classes, w["classes"][:, :-1], out=back[:-1])
        words, unbiased = np.zeros_like(w["words"]), np.ascontiguousarray(w["words"][:, :-1])
        for at, own, error in self.groups:
            np.matmul(error, unbiased[own], out=of_head[at])
            np.matmul(error.T, self.states[at], out=words[own])
        back[: len(of_head)] += of_head
        places = np.full(self.rows, len(self.found))
        places[self.order] = np.arange(len(self.found))
        return back.take(places, axis=0), self.classes.T @ self.states, words


def _rows(states: np.ndarray) -> np.ndarray:
    """A row for each step and sequence of ``states`` (steps, width, sequences); a one, for the biases, ends each."""
    steps, width, sequences = states.shape
    rows = np.ones((steps, sequences, width + 1), dtype=np.float32)
    rows[:, :, :width] = states.transpose(0, 2, 1)
    return rows.reshape(-1, width + 1)


def log_likelihoods(states: np.ndarray, targets: np.ndarray, w: Weights, bounds: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each target after its state; of the tail class for a word beyond the head."""
    return _Softmax(_rows(states.T[None]), targets, w, bounds).log_likelihoods()


@dataclass
class _Sequences:
    """Sequences side by side, the longest first, each with an end before it."""

    tokens: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    end: int

    @classmethod
    def of(cls, texts: list[np.ndarray], end: int) -> _Sequences:
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        before = np.array([end], dtype=texts[0].dtype)
        tokens = np.concatenate([x for t in texts for x in (before, t)])
        return cls(tokens, np.cumsum(lengths + 1) - lengths - 1, lengths, end)

    def window(self, start: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and targets (-1: over) of some steps of those that are not over before."""
        going = int(np.searchsorted(-self.lengths, -start))
        return self.at(np.arange(going), np.full(going, start), steps)

    def at(self, which: np.ndarray, reached: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and targets (-1: over) of some steps of those named, each from where it has been reached."""
        left = self.lengths[which] - reached
        nth = np.arange(min(steps, int(left.max(initial=0))))[:, None]
        places, inside = self.starts[which] + reached + nth, nth < left
        inputs = np.where(inside, self.tokens.take(places, mode="clip"), self.tokens.dtype.type(self.end))
        return inputs, np.where(inside, self.tokens.take(places + 1, mode="clip").astype(np.int64, copy=False), -1)


def score_sequences(texts: list[np.ndarray], w: Weights, vocabulary: Vocabulary) -> np.ndarray:
    """Log-likelihood (natural) of each whole sequence of head numbers, its state carried from window to window.

    The longest begin, side by side; when one is over, the next longest takes its place in the following window.
    """
    result = np.zeros(len(texts))
    order = np.array(sorted((i for i in range(len(texts)) if len(texts[i])), key=lambda i: -len(texts[i])), dtype=np.int64)
    if not len(order):
        return result
    side = _Sequences.of([texts[i] for i in order], vocabulary.end)
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if waiting:
            states, targets, owners = (np.concatenate(x) for x in zip(*waiting, strict=True))
            result[:] += np.bincount(owners, _Softmax(states, targets, w, vocabulary.bounds).log_likelihoods(), len(result))
            waiting.clear()
            held = 0

    which = np.arange(min(SCORED, len(order)))
    reached, begun = np.zeros(len(which), dtype=np.int64), len(which)
    state, table = np.zeros((len(which), WIDTH), dtype=np.float32), word_table(w["embed"], w["into"], w["into_bias"])
    while len(which):
        inputs, targets = side.at(which, reached, WINDOW)
        states = forward_words(inputs, table, state, w["recur"])
        waiting.append((states.reshape(-1, WIDTH + 1), targets.ravel(), np.tile(order[which], len(inputs))))
        held += targets.size
        if held >= HELD:
            flush()
        reached += WINDOW
        state = states[-1, :, :WIDTH].copy()
        over = np.flatnonzero(reached >= side.lengths[which])
        if len(over):
            free = over[: len(order) - begun]
            which[free] = np.arange(begun, begun + len(free))
            reached[free] = 0
            state[free] = 0
            begun += len(free)
            if len(free) < len(over):
                going = np.delete(np.arange(len(which)), over[len(free) :])
                which, reached, state = which[going], reached[going], state[going]
    flush()
    return result


def train_shard(texts: list[np.ndarray], w: Weights, vocabulary: Vocabulary, seed: int) -> None:
    """Truncated back-propagation through time over pieces of texts; changes ``w``."""
    rng = np.random.default_rng([SEED, seed])
    optimizer = Adagrad(w, RATE)
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    pieces.sort(key=len, reverse=True)
    batches = [pieces[i : i + SEQUENCES] for i in range(0, len(pieces), SEQUENCES)]
    for k in rng.permutation(len(batches)):
        side, start = _Sequences.of(batches[k], vocabulary.end), 0
        state = np.zeros((WIDTH, len(batches[k])), dtype=np.float32)
        inputs, targets = side.window(start, WINDOW)
        while inputs.size:
            state = _learn(inputs, targets, state[:, : inputs.shape[1]], w, vocabulary.bounds, optimizer)
            start += WINDOW
            inputs, targets = side.window(start, WINDOW)


def _learn(inputs: np.ndarray, targets: np.ndarray, state: np.ndarray, w: Weights, bounds: np.ndarray, optimizer: Adagrad) -> np.ndarray:
    embedded = np.ones((*inputs.shape, DEPTH + 1), dtype=np.float32)
    embedded[:, :, :DEPTH] = w["embed"].take(inputs, axis=0)
    states, trace = Columns.traced(Columns.projected(embedded, np.vstack([w["into"], w["into_bias"]])), state, w["recur"])
    back, classes, words = _Softmax(_rows(states), targets.ravel(), w, bounds).gradients(w)
    errors = np.ascontiguousarray(back.reshape(*targets.shape, WIDTH).transpose(0, 2, 1))
    into, recur = Columns.backward(errors, trace, w["recur"])
    rows = np.matmul(into.transpose(0, 2, 1), np.ascontiguousarray(w["into"].T)).reshape(-1, DEPTH)
    of_input = np.matmul(into, embedded).sum(axis=0).T
    optimizer.apply({"classes": classes, "words": words, "into": of_input[:-1], "into_bias": of_input[-1], "recur": recur})
    optimizer.apply_rows("embed", inputs.ravel(), rows)
    return states[-1]


def _token_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each range of texts: its first index, the hashes of its tokens, each text's end last, and where each text's start (and the end)."""
    for first, words, starts in word_hashes(texts, SPACED):
        yield first, np.insert(words, starts[1:], END), starts + np.arange(len(starts))


def token_counts(docs: DataFrame) -> DataFrame:
    """``(word, times)``: how often each token stands in the texts, words by their 64-bit hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, tokens, _ in _token_hashes(batch.column(0).to_pylist()):
                parts.append(tokens)
                held += len(tokens)
                if held > COUNTED:
                    yield _counted(parts)
                    parts, held = [], 0
        if parts:
            yield _counted(parts)

    slim = docs.select(text_bytes(F.col("text"))).mapInArrow(count, "word long, times long")
    return slim.groupBy("word").agg(F.sum("times").alias("times"))


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    words, times = np.unique(np.concatenate(parts), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["word", "times"])


def corpus_vocabulary(counts: DataFrame, frequent_words: int = FREQUENT_WORDS, head_words: int = HEAD_WORDS) -> Vocabulary:
    """Totals over all counts, and the frequent words: the end, and all above the lowest step of counts that
    ``frequent_words`` allow.

    Steps are a sixteenth of a doubling, so a histogram of a few hundred rows finds the limit without a sort.
    """
    step = F.floor(F.log2("times") * 16).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("times").alias("times")).collect()
    limit, room = None, frequent_words
    for row in sorted(histogram, key=lambda r: -r.step):
        room -= row.words
        if room < 0:
            break
        limit = row.step
    is_end = F.col("word") == int(END)
    found = counts.where(is_end if limit is None else is_end | (step >= limit))
    table = found.toArrow()
    hashes = table.column("word").to_numpy().view(np.uint64)
    tokens, types = sum(r.times for r in histogram), sum(r.words for r in histogram)
    return build_vocabulary(hashes, table.column("times").to_numpy(), tokens, types, head_words)


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS) -> Weights:
    """Weights from rounds of parallel training; each text of ``docs`` is learned from in one of them.

    A round's texts are dealt to shards by a hash. Each shard is trained in one task, from the last round's weights
    and its texts in order of a hash, so a task that is run again gives the same; the shards' weights are averaged
    block by block.
    """
    weights = new_weights(vocabulary)
    if not vocabulary.tokens:
        return weights
    spark = docs.sparkSession
    shards = max(1, round(vocabulary.tokens / rounds / shard_tokens))
    shared_words = spark.sparkContext.broadcast(vocabulary)
    kind = np.min_scalar_type(vocabulary.size)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for _, tokens, starts in _token_hashes(batch.column(1).to_pylist()):
                numbers = shared_words.value.look_up(tokens)[1].astype(kind)
                ids += [numbers[i:j].tobytes() for i, j in pairwise(starts.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["order", "ids"])

    texts = docs.select(F.xxhash64("doc_id", "text").alias("order"), text_bytes(F.col("text"))).mapInArrow(numbered, "order long, ids binary")
    texts = checkpointed(texts)
    for k in range(rounds):
        start = spark.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], start=start, k=k) -> Iterator[pa.RecordBatch]:
            for shard, part in _shards(batches, kind):
                own = {name: x.copy() for name, x in start.value.items()}
                train_shard(part, own, shared_words.value, k * 1_000_003 + shard)
                flat = np.concatenate([own[name].ravel() for name in sorted(own)])
                blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
                arrays = [pa.array(np.arange(len(blocks))), pa.array(np.full(len(blocks), shard)), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "shard", "part"])

        dealt = texts.where(F.pmod(F.xxhash64("order", F.lit("round")), F.lit(rounds)) == k)
        dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("order", F.lit("shard")), F.lit(shards)))
        trained = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "order").select("shard", "ids")
        means = trained.mapInArrow(learn, "block long, shard long, part binary").groupBy("block").applyInPandas(_mean, "block long, part binary")
        rows = means.toArrow().to_pandas().sort_values("block")
        if len(rows):
            flat = np.frombuffer(b"".join(rows["part"]), dtype=np.float32)
            for name in sorted(weights):
                size = weights[name].size
                weights[name], flat = flat[:size].reshape(weights[name].shape).copy(), flat[size:]
    return weights


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    parts = np.stack([np.frombuffer(part, dtype=np.float32) for part in rows.sort_values("shard")["part"]]).astype(np.float64)
    return pd.DataFrame({"block": rows["block"].iloc[:1].to_list(), "part": [parts.mean(axis=0).astype(np.float32).tobytes()]})


def _shards(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[int, list[np.ndarray]]]:
    shard, held = None, []
    for batch in batches:
        for now, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if now != shard and held:
                yield shard, held
                held = []
            shard = now
            held.append(np.frombuffer(ids, dtype=kind).astype(np.int64))
    if held:
        yield shard, held


PARTS = "doc_id long, key long, word long, n long, n_tokens long, n_known long, base double, model double"


def score(docs: DataFrame, vocabulary: Vocabulary, weights: Weights, counts: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` for each row of ``docs``.

    A task scores whole texts. Sums over words that aren't frequent need their counts: those words leave the task as
    one row for each text and word, are joined with the counts, and are summed by text. ``score`` is the log10
    probability of the text and its end: of each token's class and of the word in it; in the tail class a word has
    its share of the smoothed counts.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _looked_up(batches, *shared.value)

    parts = docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text"))).mapInArrow(look, PARTS)
    joined = parts.join(counts.withColumnRenamed("times", "count"), "word", "left")
    known = F.coalesce("count", F.lit(0))
    sums = joined.groupBy("doc_id", "key").agg(
        F.count("n_tokens").alias("rows"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(known > 0, F.col("n")).otherwise(0)) / F.count("n_tokens")).cast("long").alias("n_known"),
        (F.max("base") + F.sum(F.col("n") * F.log10(known + 0.5)) / F.count("n_tokens")).alias("base_score"),
        (F.max("model") + F.sum(F.col("n") * F.log10(known + 0.5)) / F.count("n_tokens")).alias("score"),
    )
    # Equal rows were one group.
    return sums.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("row", "rows", "key")


def _counted_by(owners: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, and how often each occurs."""
    order = np.lexsort((words, owners))
    owners, words = owners[order], words[order]
    first = np.flatnonzero(np.append(True, (owners[1:] != owners[:-1]) | (words[1:] != words[:-1])))
    return owners[first], words[first], np.diff(np.append(first, len(words)))


@dataclass
class _Pool:
    """Texts that wait to be scored together: the id, key and sums of each, and its head numbers."""

    ids: list[int | None] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    rows: list[np.ndarray] = field(default_factory=list)
    sequences: list[np.ndarray] = field(default_factory=list)
    tokens: int = 0

    def add(self, ids: list[int | None], keys: np.ndarray, rows: np.ndarray, sequences: list[np.ndarray]) -> None:
        self.ids += ids
        self.keys.append(keys)
        self.rows.append(rows)
        self.sequences += sequences
        self.tokens += sum(map(len, sequences))

    def scored(self, weights: Weights, vocabulary: Vocabulary) -> pa.RecordBatch:
        """The texts' rows of ``PARTS``."""
        keys, rows = np.concatenate(self.keys), np.concatenate(self.rows)
        rows[:, 3] += score_sequences(self.sequences, weights, vocabulary) / np.log(10)
        return _parts(pa.array(self.ids, pa.int64()), keys, keys, np.zeros(len(keys), dtype=np.int64), rows)


def _looked_up(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, weights: Weights) -> Iterator[pa.RecordBatch]:
    """Rows of ``PARTS`` of texts and their ids."""
    denominator = float(np.log10(vocabulary.tokens + 0.5 * (vocabulary.types + 1)))
    # What is behind the last place, -1, holds for words that aren't frequent.
    logs, seen = np.append(np.log10(vocabulary.counts + 0.5), 0), np.append(vocabulary.counts > 0, False)
    tail, kind = float(np.log10(vocabulary.tail_mass)), np.min_scalar_type(vocabulary.size)
    pool = _Pool()
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keys = np.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts], dtype=np.int64)
        for first, tokens, starts in _token_hashes(texts):
            n, begin, sizes = len(starts) - 1, starts[:-1], np.diff(starts)
            place, numbers = vocabulary.look_up(tokens)
            beyond, own = numbers == vocabulary.size, logs[place]
            base = np.add.reduceat(own, begin) - sizes * denominator
            model = np.add.reduceat(np.where(beyond, own - tail, 0), begin)
            known = np.add.reduceat(seen[place], begin, dtype=np.int64)
            pool.add(ids[first : first + n], keys[first : first + n], np.stack([sizes, known, base, model], axis=1), np.split(numbers.astype(kind), starts[1:-1]))
            rare = np.flatnonzero(place < 0)
            if len(rare):
                owners, words, times = _counted_by(np.repeat(np.arange(first, first + n), sizes)[rare], tokens[rare])
                yield _parts(batch.column(0).take(pa.array(owners)), keys[owners], words.view(np.int64), times)
            if pool.tokens >= POOLED:
                yield pool.scored(weights, vocabulary)
                pool = _Pool()
    if pool.ids:
        yield pool.scored(weights, vocabulary)


def _parts(ids: pa.Array, keys: np.ndarray, words: np.ndarray, times: np.ndarray, rows: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of ``PARTS``: with ``rows`` the sums of each text, otherwise its words that aren't frequent."""
    sums = [pa.nulls(len(keys), kind) for kind in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    if rows is not None:
        sums = [pa.array(rows[:, 0].astype(np.int64)), pa.array(rows[:, 1].astype(np.int64)), pa.array(rows[:, 2]), pa.array(rows[:, 3])]
    return pa.RecordBatch.from_arrays([ids, pa.array(keys), pa.array(words), pa.array(times), *sums], names=["doc_id", "key", "word", "n", "n_tokens", "n_known", "base", "model"])


def lm_scores(docs: DataFrame, training: Column) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``.

    Learns from the rows that meet ``training``: all their tokens are counted. A null text is empty: its only token is
    its end. Rows with a null id are scored and not learned from; equal rows get equal scores. Without training rows
    every token has probability one in the base, and one in the model that knows a single unseen word.
    """
    learned = docs.where(training & F.col("doc_id").isNotNull()).select("doc_id", "text")
    counts = checkpointed(token_counts(learned))
    vocabulary = corpus_vocabulary(counts)
    found = score(docs, vocabulary, train(learned, vocabulary), counts)
    return found.select("doc_id", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score")
