"""The prefix trie against a plain dictionary of prefixes."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from extractkit.llm import prefix_trie as trie
from extractkit.llm.prefix_trie import assembled, prefix_trie, with_shared_heads

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations_of(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in found.items()}


def rebuilt_of(found):
    out = {}
    for c, turns in found.items():
        h = crc32(str(c).encode()) % 6
        out[c] = found.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(found):
    nodes = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, members in nodes.items():
        own = (len(members) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += own
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
         sha256(",".join(str(c) for c in sorted(m) if len(found[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items()
    )


def answers(frame):
    return sorted(tuple(r) for r in frame.select(*trie._NODE).collect())


def corpus(seed, n=400):
    rng = random.Random(seed)
    texts = ["a", "b", "hello", "ümlaut", ""]
    rows = []
    for c in range(n):
        if c % 7 == 3:
            continue
        length = rng.choice([1, 2, 3, 5, 8]) if c % 40 else 45
        turns = [(rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(texts) if rng.random() < 0.3 else "same") for _ in range(length)]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "columns", "at_once"), [(16_384, 16, 64), (16, 3, 64), (7, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, size, columns, at_once):
    for name, value in (("SHARD_ROWS", size), ("COLUMNS", columns), ("SHARDS_AT_ONCE", at_once)):
        monkeypatch.setattr(trie, name, value)
    rows = corpus(size)
    found = prefix_trie(with_shared_heads(assembled(spark.createDataFrame(rows, SCHEMA))))
    assert answers(found) == brute(rebuilt_of(conversations_of(rows)))


def test_a_group_of_equal_conversations_spans_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_ROWS", 10)
    monkeypatch.setattr(trie, "SHARDS_AT_ONCE", 2)
    rows = [(c, t, "user", f"turn {t}") for c in range(120) for t in range(3)] + [(c, 0, "user", "turn 0") for c in range(200, 240)]
    rows += [(c, t, "user", f"turn {t}" if t < 2 else f"own {c}") for c in range(300, 330) for t in range(4)]
    assert answers(prefix_trie(assembled(spark.createDataFrame(rows, SCHEMA)))) == brute(conversations_of(rows))


def test_odd_rows(spark):
    rows = [
        (1, 2, "user", "b"), (1, None, "user", "a"), (1, None, None, None), (1, 2, "user", "b"), (None, 0, "user", "lost"), (2, 0, None, "x" * 50_000),
        (100, 0, "user", ""), (101, 0, "", None), (-5, 0, "user", "é"), (199, 0, "user", "a"), (307, 1, "user", "a"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("clash"), "ids": F.lit("clash")})
    found = conversations_of(rows)
    assert answers(prefix_trie(assembled(frame))) == brute(found)
    c = F.col("conv_id")
    assert answers(prefix_trie(with_shared_heads(assembled(frame.where(c > 0))))) == brute(rebuilt_of({k: v for k, v in found.items() if k > 0}))
    assert prefix_trie(assembled(frame.where("false"))).count() == 0


def test_conversations_without_turns_are_at_the_root(spark):
    rows = spark.createDataFrame([(5, [], []), (3, [], []), (9, [1, 2], [4])], "conv_id long, ids array<long>, chars array<int>")
    assert answers(prefix_trie(rows)) == [
        (3, 0, None, 3, 1, 1, 0, sha256(b"3,5").hexdigest()), (9, 1, 3, 1, 0, 1, 0, sha256(b"9").hexdigest()),
    ]
