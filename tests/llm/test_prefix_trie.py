"""The trie of conversations against sets of prefixes, on shared, nested, copied and odd ones."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n int, label string, node string"


def _rebuilt(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    out = {}
    for c, turns in own.items():
        if c is None:
            out[c] = turns
            continue
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def _brute(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    last = lambda ids: sorted(ids, key=lambda c: (c is None, c))
    rows = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        fan = {n[: d + 1] for n in members for d in [len(node)] if len(n) > d and n[:d] == node}
        inner = {n[:-1] for n in members if n}
        rows.append((
            last(ids)[0], len(node), last(members[node[:-1]])[0] if node else None, len(ids), len(fan),
            sum(n not in inner for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(",".join("null" if c is None else str(c) for c in last(ends.get(node, []))).encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def _nodes(spark, rows):
    key = F.col("conv_id")
    symbols = prefix_trie.turn_symbols(
        spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3),
        base=key - key % 5, shared=F.crc32(key.cast("string")) % 9,
    )
    return sorted(map(tuple, prefix_trie.trie_nodes(symbols).collect()), key=repr)


def _random(seed, count=60, deepest=14):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * count), count):
        for t in range(rng.randint(1, deepest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "é", None])))
    return rows


CASES = {
    "random": _random(1),
    "few symbols": _random(2, 150, 5),
    "nested": [(5 * c, t, "user", "same") for c in range(40) for t in range(c + 1)],
    "caterpillar": [(5 * c, t, "user", "same" if t < c else f"{c}") for c in range(30) for t in range(c + 1)],
    "copies": [(5 * c, t, "user", f"{t}") for c in range(50) for t in range(9)]
    + [(1000 + 5 * c, t, "user", f"{c % 3 if t else 0}") for c in range(60) for t in range(20)],
    "long": [(0, t, "user", f"{t % 7}") for t in range(300)] + [(5, t, "user", f"{t % 7}") for t in range(280)]
    + [(10, t, "user", "x" if t == 255 else f"{t % 7}") for t in range(300)],
    "odd": [(1, None, None, None), (1, 3, "user", "b"), (1, 3, "user", "b"), (2, 0, "user", "x" * 100000),
            (None, 1, "user", "a"), (None, 0, "user", "b"), (25, 0, "", ""), (30, 7, "", None)],
    "one": [(7, 0, "user", "a")],
    "turnless": [(c, 0, "user", "a") for c in (1, 2, 3, 4, 6, 7, 8, 9)],
}


@pytest.mark.parametrize("name", CASES)
def test_nodes(spark, name):
    rows = CASES[name]
    assert _nodes(spark, rows) == _brute(_rebuilt(rows))


def test_no_conversations(spark):
    assert _nodes(spark, []) == []


def test_conversations_of_their_own(spark):
    rows = [(c, t, "user", f"{t if t < 2 else c}") for c in range(12) for t in range(c % 4 + 1)]
    plain = {}
    for c, _, role, text in rows:
        plain.setdefault(c, []).append((role, text))
    symbols = prefix_trie.turn_symbols(spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA))
    assert sorted(map(tuple, prefix_trie.trie_nodes(symbols).collect()), key=repr) == _brute(plain)


def test_handles_are_at_the_two_fattest_depth(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for a, b, f in df.select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b"))).collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_more_shared_turns_than_allowed(spark):
    rows = [(c, t, "user", "a", 1, "x", "y") for c in (0, 1) for t in range(3)]
    symbols = prefix_trie.turn_symbols(
        spark.createDataFrame(rows, SCHEMA), base=F.lit(0), shared=F.lit(9)
    )
    with pytest.raises(Exception, match="shares more than 8 turns"):
        prefix_trie.conversation_paths(symbols).count()
