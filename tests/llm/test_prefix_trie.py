"""The node table of conversation prefixes against a trie of Python dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tablestream.llm import prefix_trie
from tablestream.llm.common import ready

COLUMNS = "conv_id bigint, turn bigint, role string, text string, k1 string, depth int"


@pytest.fixture(autouse=True)
def session(spark):
    return ready(spark)


def brute(rows):
    """rows: (conv_id, turn, role, text)."""
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - c % 100, [])[:h] + mine[h:]
    members: dict[tuple, list] = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children: dict[tuple, list] = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[n] for n in below) if below else 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saved + sum(saved[n] for n in below)
    out = []
    for node, who in members.items():
        ends = sorted(c for c in who if len(built[c]) == len(node))
        out.append(
            (
                min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
                len(children.get(node, [])), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], COLUMNS)


def result(spark, rows, **options):
    got = prefix_trie.rebuilt_trie(table(spark, rows), **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(seed, convs=140, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["a", "bb", "é😀", "", None][:words + 1])
            rows.append((c if c % 7 else c + 100_000, rng.choice([turn, turn, None, 3]), rng.choice(["user", None]), text))
    rows += [(5, 1, "user", "same")] * 3 + [(None, 1, "user", "no one's"), (-7, 0, "user", "below"), (12, 0, "u", "long " * 5000)]
    return rows


@pytest.mark.parametrize("seed, size", [(1, 4096), (2, 2), (3, 1)])
def test_nodes_equal_brute_force(spark, seed, size):
    rows = corpus(seed)
    assert result(spark, rows, size=size) == brute(rows)


def test_long_and_common_conversations(spark):
    """One conversation holds most rows and two share all but its last turn; many are equal."""
    long = [(200 + c, i, "user", f"t{i % 5}") for c in (0, 1) for i in range(150)]
    equal = [(c, i, "user", f"same {i}") for c in range(1000, 1400) for i in range(3)]
    rows = [*long, (201, 150, "user", "more"), *equal]
    assert result(spark, rows, size=16) == brute(rows)


def test_turnless_and_empty(spark):
    """A conversation shorter than its h, whose hundred's first is absent, has no turns."""
    alone = next(c for c in range(301, 399) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(alone, 0, "user", "x")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, [*rows, (401, 0, "u", "a"), (401, 1, "u", "a"), (400, 9, None, None)]) == brute(
        [*rows, (401, 0, "u", "a"), (401, 1, "u", "a"), (400, 9, None, None)]
    )
    assert result(spark, []) == []


def test_chunks_of_ends_join(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, 0, "user", "hello") for c in range(1, 60)]
    assert result(spark, rows) == brute(rows)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = np.zeros(5000, dtype=prefix_trie._DIGEST)
    keys["k1"], keys["k2"] = rng.integers(-(2**62), 2**62, (2, 5000))
    held = prefix_trie.SlotTable(keys[:4000])
    assert sorted(held.slots(keys[:4000])) == list(range(4000))
    assert (held.slots(keys[4000:]) == -1).all()
