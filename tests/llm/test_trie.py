"""Conversation tries against a plain version: deep and shared beginnings, odd rows, small blocks."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidemark.llm import prefix_trie
from tidemark.llm.prefix_trie import conversation_trie

# Extra columns carry names that the operator uses inside or returns.
SCHEMA = "conv_id long, turn long, role string, text string, depth int, x string, block int, n long"


def plain(rows, block=100, most=6):
    """The trie over rows (conv_id, turn, role, text); equal turns must be equal rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = {}, {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(built[c][:d], []).append(c)
        ends.setdefault(built[c], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, held in members.items():
        value = (len(held) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += value
    return sorted(
        (
            held[0], len(path), members[path[:-1]][0] if path else None, len(held),
            children.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, ends.get(path, []))).encode()).hexdigest(),
        )
        for path, held in members.items()
    )


def made(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1, 3) for r in rows], SCHEMA).repartition(3)


def odd_rows():
    draw = random.Random(5)
    rows = []
    for c in [0, 3, 7, 8, 100, 101, 115, 199, 250, 317, -5, -101, 100_003, 100_004]:
        for k in range(draw.choice([1, 2, 4, 9, 20])):
            rows.append((c, k, draw.choice(["user", "assistant", None]), draw.choice("abé漢") * 3))
    shared = [("user", f"turn {k}") for k in range(150)]
    for c, n in [(500, 150), (501, 150), (533, 77), (560, 64), (599, 65), (512, 8), (513, 1)]:
        rows += [(c, k, *shared[k]) for k in range(n)]
    rows += [(560, 64 + k, "user", "another way") for k in range(9)]
    # Null and repeated turns, a null id, empty texts.
    rows += [(700, None, "user", "first"), (700, 1, None, None), (700, 1, None, None)]
    rows += [(701, 5, "user", ""), (701, 5, "user", ""), (None, 0, "user", "nobody's")]
    return rows


@pytest.mark.parametrize("band, bits", [(8, 10), (2, 2), (4, 3)])
def test_trie(spark, monkeypatch, band, bits):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
    monkeypatch.setattr(prefix_trie, "RUN_BITS", bits)
    rows = odd_rows()
    got = conversation_trie(made(spark, rows))
    assert got.columns == prefix_trie.RESULT
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_turns_that_tie_keep_one_order(spark):
    rows = [(600, 1, "user", t) for t in "abcdef"] + [(9, 1, "user", t) for t in "fedcba"]
    one = sorted(map(tuple, conversation_trie(made(spark, rows)).collect()))
    two = sorted(map(tuple, conversation_trie(made(spark, rows[::-1])).collect()))
    assert one == two


def test_few_rows(spark):
    assert conversation_trie(made(spark, [])).collect() == []
    assert conversation_trie(made(spark, [(None, 1, "user", "x")])).collect() == []
    # A conversation whose own turns are all replaced by those of an absent one has no turn.
    lost = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(lost, 0, "user", "x")]
    got = sorted(map(tuple, conversation_trie(made(spark, rows)).collect()))
    assert got == plain(rows) and len(got) == 1


def test_a_conversation_is_cut_over_tasks(spark):
    """Rows a task takes together are bounded by blocks, however long a conversation is."""
    rows = [(1, k, "user", "x") for k in range(3000)]
    numbers = prefix_trie.numbered(prefix_trie.fingerprints(made(spark, rows)))
    assert sorted(r.pos for r in numbers.collect()) == list(range(3000))
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(conv_id" in plan and "block" in plan
