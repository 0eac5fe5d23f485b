"""The trie of conversations against brute force, over one shard and over many."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from rivermill.llm import prefix_trie, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, ids string, words string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0), key, len(WORD.findall(text))))
    own = {c: [(k, w) for _, k, w in sorted(t)] for c, t in turns.items()}
    members = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        members[c] = tuple(own.get(c - c % 20, [])[:h] + t[h:])
    nodes = defaultdict(list)
    for c, t in members.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
    children = defaultdict(int)
    for t in nodes:
        if t:
            children[t[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for t, cs in nodes.items():
        for d in range(len(t) + 1):
            leaves[t[:d]] += children[t] == 0
            saved[t[:d]] += (len(cs) - 1) * (t[-1][1] if t else 0)
    return sorted(
        (min(cs), len(t), min(nodes[t[:-1]]) if t else -1, len(cs), children[t], leaves[t], saved[t],
         hashlib.sha256(",".join(str(c) for c in sorted(cs) if members[c] == t).encode()).hexdigest())
        for t, cs in nodes.items()
    )


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = prefix_trie.trie(queries.rebuilt(prefix_trie.encode(df)[0]), **options).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in nodes)


def made(seed, size):
    """Few different turns, so that beginnings are shared; a third of all conversations alike."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(20 * size), size):
        turns = [("user", "hello there you"), ("assistant", "hi"), ("user", None)] * 3
        if c % 3:
            turns = [(rng.choice(["user", None, ""]), rng.choice(["a", "b c", "", None, "d e  f"])) for _ in range(rng.randint(1, 9))]
        order = rng.sample([None, *range(30)], len(turns))
        rows += [(c, t, r, x, "i", "w") for t, (r, x) in zip(order, turns, strict=True)]
    return rows + rows[:7] + [(None, 1, "user", "nobody", None, None)]


@pytest.mark.parametrize("shard_turns", [1 << 16, 40, 7])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = made(shard_turns, 150)
    assert got(spark, rows, shard_turns=shard_turns) == brute(rows)


def test_deep_beginnings_over_many_shards(spark):
    """Sequences that agree in their first 40 turns lie in several shards."""
    rows = [(20 * c, t, "user", f"t{t}" if t < 40 else f"own {c} {t}", None, None) for c in range(12) for t in range(40 + c % 4)]
    assert got(spark, rows, shard_turns=50) == brute(rows)


def test_ids_of_many_that_end_alike(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_BITS", 3)
    rows = [(c, 0, "user", "same", None, None) for c in range(0, 400, 3)] + [(-7, 0, "user", "same", None, None)]
    (end,) = [r.ends_sha256 for r in prefix_trie.trie(prefix_trie.encode(spark.createDataFrame(rows, SCHEMA))[0]).collect() if r.depth == 1]
    assert end == hashlib.sha256(",".join(map(str, [-7, *range(0, 400, 3)])).encode()).hexdigest()


def test_empty_table_and_turnless_conversations(spark):
    assert got(spark, []) == []
    # Conversation 24 begins with turns of the absent 20 and has none of its own after them.
    assert zlib.crc32(b"24") % 4 > 1
    assert got(spark, [(24, 1, "user", "x", None, None)]) == brute([(24, 1, "user", "x")])


def test_siblings_stay_balanced():
    ids = [[n] for n in range(1023)]
    tree, _ = prefix_trie.balanced(ids, ids)
    deepest, ranges = 0, [(tree.child[0], 1)]
    while ranges:
        at, level = ranges.pop()
        deepest = max(deepest, level)
        ranges += [(x, level + 1) for x in (tree.low[at], tree.high[at]) if x >= 0]
    assert deepest == 10
