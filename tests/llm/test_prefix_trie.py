import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import prefix_trie
from tests.llm.corpora import LONG, with_clashes

SCHEMA = "conv_id long, turn long, role string, text string"


def random_code(rng, pairs):
    """A balanced sequence: one tree around all others."""
    bits, depth, left = [True], 1, pairs - 1
    while left or depth > 1:
        if left and (depth == 1 or rng.random() < 0.55):
            bits.append(True)
            depth, left = depth + 1, left - 1
        else:
            bits.append(False)
            depth -= 1
    return np.array([*bits, False])


@pytest.mark.parametrize("pairs", [1, 2, 31, 32, 33, 500, 5000])
def test_find_close_against_a_stack(pairs):
    bits = random_code(random.Random(pairs), pairs)
    stack, close, leaves = [], {}, 0
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            leaves += bool(bits[i - 1])
            close[stack.pop()] = i
    code = prefix_trie.Parentheses(bits)
    opens = np.flatnonzero(bits)
    assert code.find_close(opens).tolist() == [close[i] for i in opens.tolist()]
    assert code.leaf_pairs[-1] == leaves


def test_a_deep_chain_closes_at_the_far_end():
    bits = np.repeat([True, False], 10_000)
    found = prefix_trie.Parentheses(bits).find_close(np.arange(10_000))
    assert found.tolist() == list(range(19_999, 9_999, -1))


def rebuilt(rows):
    """Turns (role, text) of each conversation, as the operator's contract puts it, one conversation at a time."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, prefix_hash(role or "", text or ""), role or "", text or ""))
    own = {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in own.items()}
    found = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        found[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:]
    return found


def prefix_hash(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()


def brute_force(rows):
    conversations = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter(
        (
            min(inside),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(inside),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(inside) if len(conversations[c]) == len(node)).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


def trie(spark, rows):
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    return Counter(tuple(r) for r in found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def random_rows(seed, n):
    """Conversations of few different turns, so that many share a way."""
    rng = random.Random(seed)
    rows = []
    for c in range(-n // 4, n):
        for turn in range(rng.choice([1, 1, 2, 3, 8, 12])):
            rows.append((c, turn, rng.choice(["user", None]), rng.choice(["a", "a", "é€", "c" * 9])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [1 << 20, 7])
def test_trie_against_brute_force(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    rows = random_rows(3, 60)
    assert trie(spark, rows) == brute_force(rows)


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 5)
    rows = [(c, turn, "user", f"t{turn}") for c in range(0, 600, 3) for turn in range(3)]
    rows += [(c, turn, "user", f"t{min(turn, c % 4)}") for c in range(1, 60, 3) for turn in range(12)]
    assert trie(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody's"),
        (7, None, None, None),
        (7, 3, "user", LONG),
        (7, 3, "user", "tie"),
        (7, 3, "user", "tie"),
        (-6, -5, "", ""),
        (5, 1, "user", "x"),
        (5, 1, "user", "x"),
        (1 << 62, 0, "a:", "b"),
        (9, 0, "a", ":b"),
        *((8, t, "user", str(t)) for t in range(700)),
    ]
    found = trie(spark, rows)
    assert found == brute_force(rows)
    clashing = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'h' AS head", "1 AS path", "2 AS n", "'k' AS key", "3 AS `SHARD`")
    assert prefix_trie.prefix_trie(with_clashes(clashing)).count() == found.total()
    assert trie(spark, []) == Counter()
    assert trie(spark, [(None, 1, "user", "x")]) == Counter()


def test_a_turnless_conversation_ends_at_the_root(spark):
    # The id 2 borrows turns of the conversation 0, which is not there, and has but one of its own.
    shared = zlib.crc32(b"2") % 9
    assert shared > 0
    found = trie(spark, [(2, 0, "user", "gone")])
    assert found == Counter([(2, 0, None, 1, 0, 1, 0, hashlib.sha256(b"2").hexdigest())])
