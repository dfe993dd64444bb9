from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from pitwise.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows, bits=4):
    """rows: (doc_id, text) -> sorted (doc_id, hex, component)."""
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))),
                  key=str)


def spark_rows(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_golay_code_is_perfect_and_keys_cover():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 4000)
    keys = simhash.golay_keys(words)
    count = (keys >= 0).sum(axis=1)
    assert set(count) == {1, 6}
    for flips in (1, 2):
        pos = np.array([rng.choice(23, flips, replace=False) for _ in words])
        near = words ^ (1 << pos).sum(axis=1)
        other = simhash.golay_keys(near)
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(keys, other, strict=True))
        if flips == 1:  # own index of the even word among all keys of the odd one
            a = simhash.golay_keys(words, np.bitwise_count(words) % 2 == 1)
            b = simhash.golay_keys(near, np.bitwise_count(near) % 2 == 1)
            assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_bucket_keys_cover_every_error_pattern(bits):
    rng = np.random.default_rng(bits)
    fps = rng.integers(-(1 << 63), (1 << 63) - 1, 1500)
    near = fps.copy()
    for i in range(len(near)):
        for b in rng.choice(64, bits, replace=False):
            near[i] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))

    def key_sets(x):
        out = [set() for _ in x]
        where = {int(v): i for i, v in enumerate(x)}
        for k, f in simhash.bucket_keys(x):
            for a, b in zip(k.tolist(), f.tolist(), strict=True):
                out[where[b]].add(a)
        return out

    assert all(a & b for a, b in zip(key_sets(fps), key_sets(near), strict=True))


def test_fingerprint_matches_definition():
    texts = ["", None, " \n", "one two", "A b C d", "É a b É c d e", "a b c d e f g", "x " * 1000,
             "The quick brown fox jumps over the lazy dog and runs off into the deep woods"]
    for t in texts:
        got = simhash.fingerprint(None if t is None else t.encode())
        assert got & ((1 << 64) - 1) == brute_fingerprint(t)


def planted(n=150):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(3, 200)))]
        rows.append((10 * i, " ".join(words)))
        for k in range(int(rng.integers(0, 4))):
            edit = list(words)
            edit[int(rng.integers(0, len(words)))] = "changed"
            rows.append((10 * i + k + 1, " ".join(edit)))
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = planted() + [(5001, None), (5002, ""), (5003, " \t"), (None, "w1 w2"), (None, None), (7, "w1 w2"), (7, "w1 w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spark_rows(simhash.near_duplicates(df)) == brute_components(rows)


def test_oversized_buckets_are_cut_into_blocks_without_loss(spark):
    rng = np.random.default_rng(9)
    base = int(rng.integers(0, 1 << 62))
    fps = {base}
    for _ in range(400):
        x = base
        for b in rng.choice(12, int(rng.integers(0, 6)), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    small = simhash.components(simhash.links(df, bucket_rows=20)).collect()
    whole = simhash.components(simhash.links(df)).collect()
    assert {(r.node, r.root) for r in small} == {(r.node, r.root) for r in whole}
    assert len({r.root for r in whole}) == 1


def test_deduplicate_keeps_one_of_each_group_and_all_columns(spark):
    rows = [(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "y"), (9, None, None), (8, "", "z"),
            (None, "a b c d e f", "n"), (20, "q r s t u v w", "fp")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    got = sorted(((r.doc_id, r.text, r.root) for r in simhash.deduplicate(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f", "y"), (8, "", "z"), (20, "q r s t u v w", "fp")], key=str)


def test_deduplicate_keeps_one_of_a_group_without_ids(spark):
    rows = [(None, "a b c d e f", "x")] * 5 + [(None, "q r s t u v w", "x"), (None, None, "n"), (None, " ", "n"), (4, "k l m n o p", "y")]
    got = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, root string")).collect()
    assert sorted((r.doc_id, r.root) for r in got if r.doc_id) == [(4, "y")]
    assert sorted(r.text or "" for r in got if r.doc_id is None and r.root == "x") == ["a b c d e f", "q r s t u v w"]
    assert len(got) == 4  # null and blank texts are one group


def test_deduplicate_keeps_one_of_each_group_where_ids_repeat(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (1, "q r s t u v w"), (5, "q r s t u v w"), (1, "q r s t u v w")]
    got = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, "a b c d e f"), (1, "q r s t u v w")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, fp int, key string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.deduplicate(df).collect() == []
