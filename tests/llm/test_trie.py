from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pitwise.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, part int"


def ordered(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in convs.items()}


def grafted(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs) -> dict:
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[k] for k in kids.get(node, [])]
        n = len(members[node])
        saved = (n - 1) * len(node[-1][1].encode()) if node else 0
        ends = ",".join(str(c) for c in sorted(members[node]) if len(convs[c]) == len(node))
        out[node] = (min(members[node]), len(node), min(members[node[:-1]]) if node else None, n, len(below),
                     sum(b[5] for b in below) or 1, saved + sum(b[6] for b in below), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=repr)


def got(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def talks(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bü", "", None]),
             "x", 1) for c in range(n) for t in range(rng.randrange(1, 12))]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = talks(120, seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(trie.prefix_trie(df)) == brute(ordered(rows))
    assert got(trie.grafted_trie(df)) == brute(grafted(ordered(rows)))


def test_long_and_shared_conversations_cross_tasks(spark):
    """Two copies of a talk with most of all turns, one that leaves it half way, and many equal short ones."""
    long = [(t, "user", f"turn {t}") for t in range(700)]
    rows = [(c, *x, "x", 1) for c in (5, 10, 11) for x in long]
    rows += [(20, *x, "x", 1) for x in long[:350]] + [(20, 400, "user", "elsewhere", "x", 1)]
    rows += [(c, 0, "user", "hello", "x", 1) for c in range(100, 500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert got(trie.prefix_trie(df)) == brute(ordered(rows))
        assert got(trie.grafted_trie(df)) == brute(grafted(ordered(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    rows = talks(150, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(trie, "LEAST_CELLS", 64)
    monkeypatch.setattr(trie, "MOST_CELLS", 64)
    assert got(trie.prefix_trie(df)) == brute(ordered(rows))


def test_messy_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 1, "user", ""), (2, 1, "user", "A" * 200_000), (None, 1, "user", "b"),
            (-3, 0, "user", "x"), (0, 0, "user", "y")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    assert got(trie.prefix_trie(df)) == brute(ordered(rows))
    assert trie.prefix_trie(df.limit(0)).count() == 0
    assert got(trie.prefix_trie(df.where("conv_id = 2"))) == brute(ordered(rows[3:4]))


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)  # its base is absent
    rows = [(c, 0, "user", "a"), (1000, 0, "user", "b")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    assert grafted(ordered(rows))[c] == []
    assert got(trie.grafted_trie(df)) == brute(grafted(ordered(rows)))


def test_estimates_are_never_too_low():
    rng = np.random.default_rng(7)
    hashes = [rng.bytes(16) for _ in range(3000)]
    hashes += hashes[:500]
    depth = np.ones(len(hashes), dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(depth), pa.array(hashes, pa.binary())], names=["depth", "hash"])
    bits = np.zeros((trie.ROWS, 1 << 14), dtype=bool)
    for part in (batch.slice(0, 1700), batch.slice(1700)):
        assert part.num_rows
    merged = list(trie._merge(iter([b for part in (batch.slice(0, 1700), batch.slice(1700))
                                    for b in trie._count(1 << 14)(iter([part]))])))[0]
    bits = np.zeros((trie.ROWS, (1 << 14) // 8), dtype=np.uint8)
    for at, twice in zip(merged.column("block").to_pylist(), merged.column("twice").to_pylist()):
        bits.reshape(-1, (1 << 14) // 8)[at] = np.frombuffer(twice, np.uint8)
    shared = trie.estimated_shared(batch.column("hash"), depth, bits)
    twice = np.r_[np.ones(500, bool), np.zeros(2500, bool), np.ones(500, bool)]
    assert shared[twice].all() and shared[~twice].mean() < 0.1


def test_nodes_with_their_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    told = {(r.depth, r.role, r.text) for r in trie.with_turns(trie.prefix_trie(df), df).collect()}
    assert told == {(0, None, None), (1, "user", "a"), (2, "bot", "b")}
