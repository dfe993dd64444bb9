from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwise.llm import mixing, sharding
from pitwise.llm.queries import ORACLES, QUERIES


def brute_targets(sizes, weights=(5, 2, 1), most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_equal_resharing_rule(spark):
    rng = np.random.default_rng(3)
    sizes = {f"s{i}": int(x) for i, x in enumerate(rng.integers(0, 3000, 23) ** 2 // 900)} | {None: 50, "é": 7}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long"))
    assert {r.source: r.target for r in got.collect()} == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_sources_come_near_their_target(spark, sf):
    rows = mixing.plan(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).collect()
    assert all(r.taken <= 3 * r.size for r in rows)
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        largest[r.source_size] = max(largest[r.source_size], r.size)
    assert all(abs(taken[k] - target[k]) <= min(largest[k], 0.05 * target[k]) for k in target)
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.01


def test_every_document_has_its_chance(spark):
    """Over many seeds a document gets the extra copy as often as the fraction says."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 17), "a" if i % 3 else "b") for i in range(60)],
                                 "doc_id long, text string, source string")
    extra, n = defaultdict(int), 16
    for k in range(n):
        for r in mixing.plan(docs, seed=f"s{k}").collect():
            extra[r.doc_id] += r.copies - int(r.target / r.source_size)
            rate = r.target / r.source_size
            assert int(rate) <= r.copies <= int(rate) + 1
    fraction = {r.doc_id: r.target / r.source_size % 1 for r in mixing.plan(docs).collect()}
    assert sum(extra.values()) / n == pytest.approx(sum(fraction.values()), abs=1.5)
    assert max(abs(extra[d] / n - f) for d, f in fraction.items()) < 0.4
    assert sum(abs(extra[d] / n - f) for d, f in fraction.items()) / 60 < 0.12


def test_mix_agrees_with_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    small = docs.where("doc_id < 2000")
    want = {r.doc_id: r.copies for r in mixing.plan(small).collect() if r.copies}
    assert Counter(r.doc_id for r in mixing.mix(small).collect()) == want


def test_mix_messy_and_empty(messy, empty):
    mixed = mixing.mix(messy)
    assert mixed.columns == messy.columns
    assert sum(r.copies for r in mixing.plan(messy).collect()) == mixed.count()
    assert mixing.plan(messy).count() == messy.count()
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def check_shards(rows, shards, loose=0.02):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    size = [sum(r.size for r in by[s]) for s in range(shards)]
    mean = sum(size) / shards
    assert max(abs(s - mean) for s in size) <= loose * mean + 2 * max(r.size for r in rows)


def brute_tree(points, size, first, shards, out):
    """The same splits on sorted arrays: widest dimension, nearest cut to the wanted share."""
    if shards == 1:
        out[:] = [(i, first) for i in points] + out
        return
    spans = [max(points[i][d] // sharding.CODE for i in points) - min(points[i][d] // sharding.CODE for i in points) for d in range(4)]
    d = int(np.argmax(spans))
    order = sorted(points, key=lambda i: points[i][d])
    half = shards // 2
    total = np.cumsum([size[i] for i in order])
    cut = int(np.searchsorted(total, total[-1] * half / shards))
    want, before = total[-1] * half / shards, total[cut - 1] if cut else 0
    cut = cut if want - before < total[cut] - want else cut + 1
    brute_tree({i: points[i] for i in order[:cut]}, size, first, half, out)
    brute_tree({i: points[i] for i in order[cut:]}, size, first + half, shards - half, out)


def test_kd_tree_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TOLERANCE", 0.0)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    points = sharding._points(docs, "doc_id", "text", "source", "lang")
    of = {r.text_hash: r.doc_id for r in points.collect()}
    rows = sharding._scaled(points.withColumn("piece", F.lit(0)).withColumn("x0", F.log2("size"))).collect()
    points = {of[r.text_hash]: (r.c0, r.c1, r.c2, r.c3) for r in rows}
    want: list = []
    brute_tree(points, {of[r.text_hash]: r.size for r in rows}, 0, 7, want)
    got = sharding.kd_shards(docs, shards=7).collect()
    assert {r.doc_id: r.shard for r in got} == dict(want)


def test_hot_copies_and_repeated_rows_stay_balanced(spark):
    rows = [(5, "the same text again and again", "en", "a")] * 3000 + [
        (100 + i, f"text number {i} " * (1 + i % 7), "en", f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    check_shards(sharding.kd_shards(docs).collect(), 24)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_equal_texts_share_a_shard(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = sharding.kd_shards(docs).collect()
    check_shards(rows, 24)
    homes, held = defaultdict(set), Counter()
    for r in rows:
        homes[r.size, r.text_crc32].add(r.shard)
        held[r.size, r.text_crc32] += r.size
    most = max(max(r.size for r in rows), 0.02 * sum(r.size for r in rows) / 24)
    assert len(homes) < len(rows)
    assert all(len(s) == 1 for g, s in homes.items() if held[g] <= most)


def test_ids_that_are_text(spark):
    docs = spark.createDataFrame([(f"id-{i}" if i % 3 else None if i % 2 else str(i), f"text {i}", "en", "s") for i in range(200)],
                                 "doc_id string, text string, lang string, source string")
    rows = sharding.kd_shards(docs, shards=5).collect()
    check_shards(rows, 5)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())


def test_target_bytes_messy_and_empty(messy, empty):
    got = sharding.kd_shards(messy).collect()
    assert len(got) == messy.count() and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert {r.size for r in got if r.doc_id in (2, 3)} == {8} and {r.text_crc32 for r in got if r.doc_id == 3} == {0}
    one = sharding.kd_shards(messy, target_bytes=10 ** 9).collect()
    assert {r.shard for r in one} == {0}
    assert sharding.kd_shards(empty).count() == 0


def test_op6_oracle_is_registered():
    assert "op6_mix_sources" in ORACLES and {f"op{i}" for i in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
