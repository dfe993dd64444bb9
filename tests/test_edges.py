"""Edge cases: NULL and repeated keys, ties, overflows, limits, awkward text, missing fields."""

from __future__ import annotations

from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwise.operators import metrics as M
from pitwise.operators.asof import asof_join, asof_join_weekly
from pitwise.operators.fingerprint import content_fingerprint, fingerprint_parts
from pitwise.operators.ordering import assign_ids, running_sums
from pitwise.operators.quantiles import exact_quantiles
from pitwise.operators.splits import temporal_split
from pitwise.operators.windows import WINDOW_FEATURES, customer_window_features
from pitwise.plans import models as ML
from pitwise.plans.contract import Contract, coerce, validate
from pitwise.session import ensure_checkpoint_dir
from pitwise.sources import etl
from pitwise.streaming.scoring import run_to_completion

T0 = datetime(2024, 3, 4, 12, 0, 0)


@pytest.mark.parametrize("order,first", [("asc", True), ("desc", False), ("asc_nulls_last", False), ("desc_nulls_first", True)])
def test_null_keys_are_numbered_with_one_and_many_buckets(spark, order, first):
    df = spark.range(100).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), "id")
    lead = getattr(F.col("k"), order)()
    down = order.startswith("desc")
    sign = F.lit(-1) if down else F.lit(1)
    got = [{r["id"]: r["row_id"] for r in assign_ids(df, [lead, "id"], num_buckets=n, bucket_key=sign * F.col("k")).collect()}
           for n in (1, 4)]
    assert got[0] == got[1] and sorted(got[0].values()) == list(range(100))
    nulls = [got[1][i] for i in range(0, 100, 10)]
    assert nulls == (list(range(10)) if first else list(range(90, 100)))
    sums = running_sums(df.withColumn("one", F.lit(1)), [lead, "id"], ["one"], num_buckets=4, bucket_key=F.col("k"), descending=down)
    assert {r["id"]: r["one_cum"] - 1 for r in sums.collect()} == got[0]


def test_split_window_path_equals_single_window_on_awkward_rows(spark):
    rows = []
    for i in range(60):
        customer = None if i % 3 == 0 else 1
        when = None if i % 11 == 0 else T0 + timedelta(minutes=17 * i)
        rows.append((None if i % 7 == 0 else 1000 + i // 2, customer, when, float(10 + i % 9), "declined" if i % 4 == 0 else "ok"))
    rows += [(5000 + i, 2, T0 + timedelta(days=i), 5.0, "ok") for i in range(5)]
    schema = "transaction_id long, customer_id long, authorized_at timestamp_ntz, amount double, auth_result string"
    # repeated ids at one time would leave the order open, so they differ in time here
    tx = spark.createDataFrame(rows, schema)
    key = ["customer_id", "authorized_at", "transaction_id", "amount", *WINDOW_FEATURES]
    one = sorted(map(str, customer_window_features(tx).select(key).collect()))
    split = sorted(map(str, customer_window_features(tx, hot_threshold=10, bucket_seconds=3600, block_rows=7).select(key).collect()))
    with_time = lambda x: [r for r in x if "authorized_at=None" not in r]  # noqa: E731  (rows at one time: order by id only)
    assert len(split) == len(rows) and with_time(split) == with_time(one)


def test_quantiles_of_tied_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    v = np.array([r["v"] for r in df.collect()])
    qs = [0.0, 0.1, 0.5, 0.895, 0.9, 0.95, 1.0]
    assert exact_quantiles(df, "v", qs).first()["q"] == pytest.approx(list(np.quantile(v, qs)))


def test_roc_auc_of_a_million_rows_and_of_large_counts(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") * 7919 % 1009 + F.col("id") % 3).cast("double").alias("score"))
    ids = np.arange(n)
    y, s = ids % 3 == 0, ids * 7919 % 1009 + ids % 3
    pos, neg = (np.bincount(s[k], minlength=1012) for k in (y, ~y))
    below = np.cumsum(neg) - neg
    want = (pos * (below + neg / 2)).sum() / (pos.sum() * neg.sum())
    assert M.roc_auc(df).first()[0] == pytest.approx(round(want, 6), abs=1e-9)


def test_roc_auc_formula_holds_counts_above_int_and_long(spark, monkeypatch):
    big = 10 ** 12
    curve = spark.createDataFrame([(0.9, big, 0, big, 0), (0.1, 0, big, big, big)], "threshold double, pos long, neg long, tp long, fp long")
    monkeypatch.setattr(M, "class_totals", lambda *a: (F.lit(big), F.lit(big)))
    monkeypatch.setattr(M, "score_curve", lambda *a: curve)
    assert M.roc_auc(curve).first()[0] == 1.0


def test_fingerprint_is_unambiguous_and_sums_are_decimal(spark):
    f = lambda *rows: content_fingerprint(spark.createDataFrame(list(rows), "a string, b string")).first()["sha256"]
    assert len({f(("x|y", "z")), f(("x", "y|z")), f(("-", None)), f((None, "-")), f((None, None)), f(("\\N", ""))}) == 6
    assert f(("p", "q"), ("r", "s")) == f(("r", "s"), ("p", "q"))
    parts = fingerprint_parts(spark.createDataFrame([("a",)], "a string"))
    assert dict(parts.dtypes)["s0"] == "decimal(38,0)"


def test_asof_keeps_fractions_and_weekly_grid_is_checked(spark):
    left = spark.createDataFrame([(1, 10.2), (1, 10.9)], "k int, t double")
    right = spark.createDataFrame([(1, 10.7, "new"), (1, 9.0, "old")], "k int, rt double, v string")
    for bucket in (None, 1):
        got = {r["t"]: r["v"] for r in asof_join(left, right, "k", "t", "rt", ["v"], bucket_seconds=bucket).collect()}
        assert got == {10.2: "old", 10.9: "new"}
    ops = spark.createDataFrame([(1, T0)], "k int, t timestamp_ntz")
    off = spark.createDataFrame([(1, T0 - timedelta(days=9), 1.0)], "k int, a timestamp_ntz, v double")
    with pytest.raises(Exception, match="not a Monday"):
        asof_join_weekly(ops, off, "k", "t", "a", ["v"]).collect()


def test_csv_keeps_awkward_text(spark, tmp_path):
    texts = ["a\nb", "\\N", " pad ", "q\"uo\"te", "back\\slash\\n", "\r\n", "", None, "c,d", "\\\\N"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    etl.write_csv(df, str(tmp_path / "c"))
    back = etl.read_csv(spark, str(tmp_path / "c"), df.schema).orderBy("id").collect()
    assert [r["t"] for r in back] == texts


def test_reload_replaces_the_table(spark, tables, tmp_path):
    from pitwise.sources.schemas import TABLES

    path = str(tmp_path / "customers")
    etl.reload_table(tables.customers, TABLES["customers"], path)
    etl.reload_table(tables.customers.limit(5), TABLES["customers"], path)
    assert spark.read.parquet(path).count() == 5


def test_requests_without_a_numeric_field_are_scored_as_missing(spark):
    c = Contract(features=["amount", "hour", "channel"], cat_features=["channel"])
    ok, bad = validate(spark.createDataFrame([("pos", "12"), (None, "1"), ("web", "x")], "channel string, amount string"), c)
    assert [tuple(r) for r in coerce(ok, c).select("amount", "hour", "channel").collect()] == [(12.0, None, "pos")]
    assert sorted(r["reasons"][0] for r in bad.collect()) == ["missing:channel", "not_numeric:amount"]
    with pytest.raises(ValueError):
        validate(spark.createDataFrame([("1",)], "amount string"), c)


def test_preprocessing_sees_training_rows_only(spark):
    c = Contract(features=["amount", "channel"], cat_features=["channel"])
    train = spark.createDataFrame([(1.0 + i % 2, f"c{i % 100}", i % 2) for i in range(200)], "amount double, channel string, label int")
    val = [spark.createDataFrame([(v, name, i % 2) for i in range(20)], "amount double, channel string, label int")
           for v, name in ((99.0, "only-in-val"), (-5.0, "c1"))]
    fits = [ML.fit_trees(ML.gbt(c, max_iter=2), ML.prepare(train, c), c, ML.prepare(x, c)) for x in val]
    for a, b in zip(*(f.stages[:2] for f in fits), strict=True):
        if a.__class__.__name__ == "StringIndexerModel":
            assert a.labels == b.labels and "only-in-val" not in a.labels
        else:
            assert a.surrogateDF.first() == b.surrogateDF.first()
    assert fits[0].stages[-1].getOrDefault("maxBins") >= 101  # more categories than the default bins


def test_split_by_the_texts_of_a_manifest(spark):
    df = spark.createDataFrame([(T0 + timedelta(hours=i),) for i in range(4)], "authorized_at timestamp_ntz")
    cuts = spark.createDataFrame([("2024-03-04 13:00:00", "2024-03-04 14:00:00")], "train_end string, val_end string")
    assert [r["split"] for r in temporal_split(df, cuts).orderBy("authorized_at").collect()] == ["train", "train", "val", "test"]


def test_a_stream_over_its_limit_is_stopped_and_raises(spark, tmp_path):
    q = (spark.readStream.format("rate").load().writeStream.format("parquet").option("path", str(tmp_path / "o"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start())
    with pytest.raises(TimeoutError):
        run_to_completion([q], timeout_s=2)
    assert not q.isActive


def test_no_machine_local_folder_off_a_local_master():
    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))
    context.getCheckpointDir = lambda: "/shared/registered"
    assert ensure_checkpoint_dir(SimpleNamespace(sparkContext=context)) == "/shared/registered"


def test_permutation_importance_finds_the_feature_that_counts(spark):
    from pitwise.plans.attribution import permutation_importance

    c = Contract(features=["amount", "hour", "channel"], cat_features=["channel"])
    rows = spark.range(400).select(
        F.col("id").alias("transaction_id"), (F.col("id") * 37 % 101).cast("double").alias("amount"),
        (F.col("id") * 13 % 24).cast("double").alias("hour"), F.when(F.col("id") % 2 == 0, "a").alias("channel")).withColumn(
        "label", (F.col("amount") > 50).cast("int"))
    model = ML.fit_trees(ML.gbt(c, max_iter=5, validation_col=None), ML.prepare(rows, c), c)
    got = [tuple(r) for r in permutation_importance(model, rows, c).collect()]
    assert [g[2] for g in got] == [1, 2, 3] and got[0][0] == "amount" and got[0][1] > 10 * max(got[1][1], 1e-6)


def test_asof_null_keys_match_nothing(spark):
    """A NULL key is no key, in every form of the join; many of them are no window's work."""
    from datetime import datetime

    from pitwise.operators.asof import asof_join, asof_join_weekly

    monday = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, None, monday), (2, 5, monday), (3, None, None), (4, 6, monday)] + [(9, 7, monday)] * 5,
                                 "id int, k int, t timestamp_ntz")
    right = spark.createDataFrame([(None, monday, 7.0), (5, monday, 8.0)], "k int, at timestamp_ntz, v double")
    want = {1: None, 2: 8.0, 3: None, 4: None, 9: None}
    forms = [asof_join(left, right, "k", "t", "at", ["v"]), asof_join(left, right, "k", "t", "at", ["v"], bucket_seconds=3600),
             asof_join(left, right, "k", "t", "at", ["v"], hot_threshold=3), asof_join_weekly(left, right, "k", "t", "at", ["v"])]
    for out in forms:
        assert out.count() == 9 and {r.id: r.v for r in out.collect()} == want


def test_asof_queries_join_the_operations_once(spark, tables):
    """Operations are a join of the largest tables: written once, then read by every branch of the as-of join."""
    from pitwise.plans.queries_features import q_asof_merchant_rate_hot_split

    read = q_asof_merchant_rate_hot_split(tables).inputFiles()
    assert read and not [f for f in read if "lineitem" in f or "orders" in f]


def test_the_matrix_reads_operations_that_are_written_once(spark, tables, monkeypatch):
    """A publish joins the largest tables once, not once for each step that reads operations."""
    from pitwise.plans import queries_eval as Q

    seen = []
    kept = Q.publish
    monkeypatch.setattr(Q, "publish", lambda spark, matrix, tx, *a, **k: (seen.append(tx.inputFiles()), kept(spark, matrix, tx, *a, **k))[1])
    out = Q.q_snapshot_publish(tables)
    assert out.count() == 2 and len(seen) == 2
    assert all(files and not [f for f in files if "lineitem" in f or "orders" in f] for files in seen)
