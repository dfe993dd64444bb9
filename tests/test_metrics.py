"""Metrics against brute-force definitions on small inputs, and sampling exactness."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pitwise.operators import metrics as M
from pitwise.operators.ordering import assign_ids, running_sums
from pitwise.operators.quantiles import exact_quantiles
from pitwise.operators.sampling import capped_sample, undersample


def brute(y, s, target):
    pairs = [(a, b) for a, b in itertools.product(range(len(y)), repeat=2) if y[a] == 1 and y[b] == 0]
    auc = sum(1.0 if s[a] > s[b] else 0.5 if s[a] == s[b] else 0.0 for a, b in pairs) / len(pairs)
    P = sum(y)
    thr = sorted(set(s), reverse=True)
    tp = [sum(1 for yi, si in zip(y, s) if si >= t and yi == 1) for t in thr]
    fp = [sum(1 for yi, si in zip(y, s) if si >= t and yi == 0) for t in thr]
    prec = [a / (a + b) for a, b in zip(tp, fp)]
    rec = [a / P for a in tp]
    ap, prev = 0.0, 0.0
    for p, r in zip(prec, rec):
        ap += (r - prev) * p
        prev = r
    ok = [t for t, r in zip(thr, rec) if r >= target]
    pick = max(ok) if ok else min(thr)
    par = max([p for p, r in zip(prec, rec) if r >= target], default=0.0)
    return auc, ap, pick, par


@pytest.mark.parametrize("case", ["random", "all_tied", "perfect"])
def test_ranking_metrics_match_definitions(spark, case):
    rnd = random.Random(7)
    n = 60
    y = [1 if rnd.random() < 0.3 else 0 for _ in range(n)]
    y[0], y[1] = 1, 0
    if case == "random":
        s = [round(rnd.random(), 1) for _ in range(n)]  # coarse: many ties
    elif case == "all_tied":
        s = [0.5] * n
    else:
        s = [0.9 if v else 0.1 for v in y]
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    auc, ap, pick, par = brute(y, s, 0.8)
    assert M.roc_auc(df).first()[0] == pytest.approx(round(auc, 6), abs=1e-9)
    assert M.average_precision(df).first()[0] == pytest.approx(round(ap, 6), abs=1e-9)
    assert M.pick_threshold(df, target_recall=0.8).first()[0] == pick
    assert M.precision_at_recall(df, target_recall=0.8).first()[0] == pytest.approx(round(par, 6), abs=1e-9)


def test_running_sums_and_ids_across_buckets(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(1).alias("one"))
    ids = assign_ids(df, ["k"], num_buckets=7)
    assert sorted(r["row_id"] for r in ids.collect()) == list(range(1000))
    assert ids.filter(F.col("row_id") != F.col("k")).count() == 0
    cum = running_sums(df, [F.col("k").desc()], ["one"], num_buckets=5, bucket_key=F.col("k"), descending=True)
    assert cum.filter(F.col("one_cum") != F.lit(1000) - F.col("k")).count() == 0


def test_exact_quantiles_linear(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    q = exact_quantiles(df, "v", [0.0, 0.25, 0.7, 1.0]).first()[0]
    s = sorted(vals)

    def lin(p):
        pos = p * (len(s) - 1)
        lo = int(pos)
        hi = min(lo + 1, len(s) - 1)
        return s[lo] + (pos - lo) * (s[hi] - s[lo])

    assert q == pytest.approx([lin(p) for p in [0.0, 0.25, 0.7, 1.0]])


def test_undersample_exact_and_keeps_positives(spark):
    data = [(i, 1 if i % 25 == 0 else 0) for i in range(2000)]
    df = spark.createDataFrame(data, "transaction_id long, label int")
    out = undersample(df, neg_per_pos=5, seed=42)
    pos = sum(1 for _, l in data if l == 1)
    got = out.groupBy("label").count().collect()
    counts = {r["label"]: r["count"] for r in got}
    assert counts == {1: pos, 0: 5 * pos}
    again = undersample(df.repartition(7), neg_per_pos=5, seed=42)
    assert sorted(r[0] for r in out.collect()) == sorted(r[0] for r in again.collect())
    assert capped_sample(df, 100, "transaction_id").count() == 100
    assert capped_sample(df, 5000, "transaction_id").count() == 2000


def test_confusion_and_fp_reduction(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.8), (0, 0.1)], "label int, score double")
    c = M.confusion(df, 0.5).first()
    assert (c["tp"], c["fp"], c["fn"], c["recall"], c["precision"]) == (1, 1, 1, 0.5, 0.5)
    r = M.fp_reduction(M.confusion(df, 0.5), 0.05).first()
    assert r["rules_fp"] == pytest.approx(19.0)
    assert r["fp_reduction"] == pytest.approx(1 - 1 / 19, abs=1e-6)
    assert r["alerts_per_fraud"] == pytest.approx(2.0)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0.3), (0, 0.7), (0, 0.7)], "label int, score double")
    assert M.roc_auc(df).first()[0] is None
    assert M.average_precision(df).first()[0] is None
    assert M.pick_threshold(df).first()[0] == 0.7  # every threshold has full recall by convention
    assert M.precision_at_recall(df).first()[0] == 0.0
    c = M.confusion(df, 0.5).first()
    assert (c["tp"], c["fp"], c["recall"], c["precision"]) == (0, 2, 0.0, 0.0)


def test_grouped_ranking_equals_each_group_by_itself(spark):
    rng = random.Random(5)
    rows = [(g, rng.random() < p, rng.choice([None, round(rng.random(), k), round(rng.random(), k)]))
            for g, n, p, k in (("hot", 900, 0.2, 3), ("ties", 200, 0.5, 1), ("one", 1, 1, 2), ("none", 50, 0, 2), ("all", 30, 1, 2),
                               (None, 20, 0.5, 2)) for _ in range(n)]
    df = spark.createDataFrame([(g, int(y), s) for g, y, s in rows], "g string, label int, score double").repartition(4)
    got = {r.g: r for r in M.grouped_ranking(df, "g", target_recall=0.6, num_blocks=7).collect()}
    assert set(got) == {g for g, _, s in rows if g is not None and s is not None}
    for g, r in got.items():
        part = df.where(F.col("g") == g)
        assert r.roc_auc == M.roc_auc(part).first()[0] and r.average_precision == M.average_precision(part).first()[0]
        assert r.precision_at_recall == M.precision_at_recall(part, target_recall=0.6).first()[0]
        assert r.pos + r.neg == part.where("score IS NOT NULL").count()


@pytest.mark.parametrize("seed", range(6))
def test_sample_is_the_same_with_and_without_prefilter_on_null_and_repeated_ids(spark, seed):
    from pitwise.operators.sampling import hash_top_n

    rows = [(None if i < 100 else i // 3, i) for i in range(1000)]  # a tenth without an id, the others in threes
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    pick = lambda total: sorted(r.v for r in hash_top_n(df, 200, "id", seed, total=total).collect())
    with_filter, without = pick(1000), pick(None)
    assert with_filter == without and len(set(without)) == 200
    assert 5 <= sum(v < 100 for v in without) <= 40  # rows without an id have their share, neither none nor all
    assert pick(1000) == sorted(r.v for r in hash_top_n(df.repartition(3), 200, "id", seed, total=1000).collect())


def test_sampling_numbers_only_the_rows_at_its_edge(spark, monkeypatch):
    from pitwise.operators import sampling as S

    df = spark.range(20_000).withColumnRenamed("id", "transaction_id").withColumn("label", (F.col("transaction_id") % 50 == 0).cast("int"))
    monkeypatch.setattr(S, "NUMBERED_ROWS", 0)
    numbered, number = [], S.assign_ids
    monkeypatch.setattr(S, "assign_ids", lambda pool, *a, **k: numbered.append(pool.count()) or number(pool, *a, **k))
    got = {r[0] for r in S.undersample(df, seed=7).where("label = 0").select("transaction_id").collect()}
    h = df.where("label = 0").select("transaction_id", F.md5(F.concat(F.lit("7:"), F.col("transaction_id").cast("string"))).alias("h"))
    assert got == {r[0] for r in h.orderBy("h").limit(8000).collect()} and len(got) == 8000
    assert len(numbered) == 1 and 0 < numbered[0] < 100
    odd = spark.createDataFrame([(None if i < 100 else i // 3, i) for i in range(1000)], "id long, v long").repartition(5)
    pick = lambda: sorted(r.v for r in S.hash_top_n(odd, 200, "id", 3, total=1000).collect())
    by_digits = pick()
    monkeypatch.setattr(S, "NUMBERED_ROWS", 1000)
    assert pick() == by_digits
