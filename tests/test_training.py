"""Boosting that stops on AUC, importance by average precision, the model cache."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pitwise.operators import metrics as M
from pitwise.plans import attribution as A
from pitwise.plans import models as ML
from pitwise.plans.contract import Contract
from pitwise.session import drop_scratch

FEATURES = ["amount", "channel", "vel_1h"]


@pytest.fixture(scope="module")
def contract():
    return Contract(features=FEATURES, cat_features=["channel"])


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)
    out = []
    for i in range(600):
        amount, channel, vel = rng.random(), rng.choice("abc"), rng.choice([None, 0, 1, 2, 5])
        p = 0.1 + 0.5 * (amount > 0.7) + 0.2 * (channel == "b")
        out.append((i, amount, channel, vel, int(rng.random() < p)))
    return spark.createDataFrame(out, "transaction_id long, amount double, channel string, vel_1h long, label int").repartition(3).cache()


@pytest.fixture(scope="module")
def fitted(rows, contract):
    train, val = rows.where("transaction_id < 400"), rows.where("transaction_id >= 400")
    train, val = ML.prepare(train, contract), ML.prepare(val, contract)
    return train, val, ML.fit_trees(ML.gbt(contract, max_iter=12, depth=3, validation_col=None), train, contract)


def margins(model, df):
    return {r.transaction_id: r.m for r in model.transform(df).select(
        "transaction_id", vector_to_array("rawPrediction")[1].alias("m")).collect()}


def test_staged_margins_are_those_of_the_model_cut_short(fitted, contract, tmp_path):
    _, val, model = fitted
    staged = ML.staged_margins(model, val, contract.label)
    for n in (1, 5, 12):
        cut = ML.first_trees(model, n)
        assert cut.stages[-1].getNumTrees == n and cut.stages[-1].getOrDefault("maxDepth") == 3
        want = sorted(margins(cut, val).values())
        got = sorted(r.margin for r in staged.where(F.col("iteration") == n).collect())
        assert got == pytest.approx(want, abs=1e-12)
    assert margins(ML.first_trees(model, 12), val) == margins(model, val)
    cut.write().overwrite().save(str(tmp_path / "m"))
    assert margins(type(cut).load(str(tmp_path / "m")), val) == margins(cut, val)


def test_first_trees_equal_a_shorter_run(fitted, contract):
    train, val, model = fitted
    short = ML.fit_trees(ML.gbt(contract, max_iter=4, depth=3, validation_col=None), train, contract)
    assert margins(ML.first_trees(model, 4), val) == pytest.approx(margins(short, val), abs=1e-12)


def test_staged_auc_and_the_stop(fitted, contract, monkeypatch):
    train, val, model = fitted
    auc = {r.iteration: r.roc_auc for r in ML.staged_auc(model, val, contract.label).collect()}
    for n in (1, 6, 12):
        pred = ML.first_trees(model, n).transform(val).select("label", vector_to_array("rawPrediction")[1].alias("s"))
        assert auc[n] == M.roc_auc(pred, "label", "s").first()[0]
    monkeypatch.setattr(ML, "FIRST_TREES", 4)
    stopped, best = ML.boost(train, val, contract, max_iter=12, stale=3, depth=3)
    # the rule, replayed on the whole run: the first best round that is `stale` rounds old, or the best of all
    top = 0
    for n in range(1, 13):
        top = n if not top or auc[n] > auc[top] else top
        if n - top >= 3:
            break
    assert stopped.stages[-1].getNumTrees == top or auc[stopped.stages[-1].getNumTrees] >= auc[top]
    assert best == auc[stopped.stages[-1].getNumTrees]


def test_best_round_is_told_by_bins_and_runs_double(fitted, contract, monkeypatch):
    train, val, model = fitted
    auc = {r.iteration: r.roc_auc for r in ML.staged_auc(model, val, contract.label).collect()}
    for bins in (1, 4, 8192):  # wide bins tell less, and never lose a best round
        monkeypatch.setattr(ML, "MARGIN_BINS", bins)
        hopeful = ML.hopeful_rounds(model, val, contract.label)
        assert {k for k in auc if auc[k] == max(auc.values())} <= set(hopeful) <= set(auc)
    assert {r.iteration: r.roc_auc for r in ML.staged_auc(model, val, contract.label, hopeful).collect()} == {k: auc[k] for k in hopeful}
    asked = []
    monkeypatch.setattr(ML, "FIRST_TREES", 2)
    monkeypatch.setattr(ML, "gbt", lambda c, max_iter, make=ML.gbt, **k: asked.append(max_iter) or make(c, max_iter=max_iter, **k))
    monkeypatch.setattr(ML, "hopeful_rounds", lambda m, *_: [m.stages[-1].getNumTrees])  # always the last
    ML.boost(train, val, contract, max_iter=16, stale=1, depth=2)
    assert asked == [2, 4, 8, 16]


def test_training_rows_keep_the_cores_busy(spark, rows, monkeypatch):
    monkeypatch.setattr(ML, "TASK_ROWS", 100)
    assert ML.sized(rows, 600).rdd.getNumPartitions() == min(6, spark.sparkContext.defaultParallelism) > 1
    assert ML.sized(rows, 80).rdd.getNumPartitions() == 1 and ML.sized(rows, 600).count() == 600


def test_importance_is_the_loss_of_average_precision(rows, fitted, contract):
    _, _, model = fitted
    got = {r.feature: r for r in A.permutation_importance(model, rows, contract).collect()}
    frames = A.permuted(rows, contract.features, "transaction_id", 42)
    ap = {}
    for f in ("", *FEATURES):
        pred = model.transform(ML.prepare(frames.where(F.col("feature") == f), contract))
        ap[f] = M.average_precision(pred.select("label", ML.positive_score(pred).alias("s")), "label", "s").first()[0]
        assert pred.count() == rows.count()
    assert set(got) == set(FEATURES)
    for f in FEATURES:
        assert got[f].average_precision == ap[f] and got[f].ap_loss == pytest.approx(ap[""] - ap[f], abs=1e-9)
    assert got["amount"].rank == 1 and got["amount"].ap_loss > 0.05


def test_leaderboard_takes_the_fitted_booster(rows, contract, monkeypatch):
    from pitwise.plans import training as TR

    train, val = rows.where("transaction_id < 400"), rows.where("transaction_id >= 400")
    t = TR.train_and_calibrate(train, val, contract, max_iter=3)
    assert t.params["best_iteration"] == t.n_trees <= 3 and 0.5 < t.params["best_val_auc"] <= 1
    monkeypatch.setattr(ML, "boost", None)  # not called
    table = {r.model: r for r in TR.leaderboard(train, val, contract, rf_trees=5, linear_iter=20, booster=t).collect()}
    assert set(table) == {"GBT", "RandomForest", "LogReg", "LinearSVC"}
    pred = t.model.transform(ML.prepare(val, contract))
    s = pred.select("label", ML.positive_score(pred).alias("s"))
    assert table["GBT"].roc_auc == pytest.approx(M.roc_auc(s, "label", "s").first()[0], abs=1e-4)
    assert table["GBT"].prec_at_rec80 == pytest.approx(M.precision_at_recall(s, "label", "s").first()[0], abs=1e-4)


def test_shared_tables_outlive_dropped_scratch_and_follow_their_tables(spark, tmp_path):
    import shutil

    from pitwise.plans import queries_models as Q
    from pitwise.sources.fixtures import RAW_TABLES, Tables

    for name in RAW_TABLES:
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    t = Tables(spark, str(tmp_path))
    first = Q._parts(t)
    drop_scratch(spark)
    assert first["train"].count() > 0 and Q._parts(t) is first
    key = Q._key(t, "x")
    shutil.copyfile("/root/testdata/sf0.01/customer.parquet", tmp_path / "customer.parquet")
    assert Q._key(Tables(spark, str(tmp_path)), "x") != key  # customer is read too
    assert Q.drop_shared(spark) > 0 and not Q._CACHE


def test_state_of_the_tables_is_told_by_a_listing_of_files(spark, tmp_path):
    """One job over all tables, with a row a file instead of a row a row."""
    from pitwise.plans import queries_models as Q
    from pitwise.sources.fixtures import RAW_TABLES, Tables

    home = tmp_path / "a b"  # a name that is encoded in a file's address
    for name in RAW_TABLES:
        spark.range(100).repartition(2).write.parquet(str(home / f"{name}.parquet"))
    t = Tables(spark, str(home))
    spark.sparkContext.setJobGroup("listing", "")
    key = Q._key(t, "x")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("listing"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert key[-1][0] == 2 * len(RAW_TABLES) and jobs <= 2 and Q._key(t, "x") == key
    spark.range(7).write.mode("append").parquet(str(home / f"{RAW_TABLES[-1]}.parquet"))
    assert Q._key(Tables(spark, str(home)), "x") != key


def test_importance_scores_only_rows_that_an_exchange_changes(spark, contract, rows, fitted, monkeypatch):
    """Each variant has the probability that scoring the exchanged rows gives; equal values, nulls too, are not scored again."""
    _, _, model = fitted
    few = rows.where("transaction_id < 200")
    every = A.permuted(few, contract.features, "transaction_id", 42)
    pred = model.transform(ML.prepare(every, contract))
    want = sorted((r.feature, r.label, r.p) for r in pred.select("feature", "label", ML.positive_score(pred).alias("p")).collect())
    scored, score = [], type(model.stages[-1]).transform
    monkeypatch.setattr(type(model.stages[-1]), "transform", lambda self, d, *a: scored.append(d.count()) or score(self, d, *a))
    got = A.permuted_scores(model, few, contract, "transaction_id", 42).collect()
    assert sorted((r.feature, r.label, r.p) for r in got) == want and len(got) == 200 * (1 + len(FEATURES))
    assert scored[0] == 200 and 200 < scored[1] < 200 * len(FEATURES)
    assert all(r.p == r.p0 for r in got if r.feature == "")


def test_linear_models_of_the_leaderboard_share_their_preparation(rows, contract, monkeypatch):
    from pitwise.plans import training as TR

    train, val = rows.where("transaction_id < 400"), rows.where("transaction_id >= 400")
    made, make = [], ML.linear_preparation
    monkeypatch.setattr(ML, "linear_preparation", lambda *a: made.append(1) or make(*a))
    table = {r.model: r for r in TR.leaderboard(train, val, contract, gbt_iter=2, rf_trees=5, linear_iter=20).collect()}
    assert len(made) == 1 and len(table) == 4
    alone = ML.logistic(contract, 400, 20).fit(ML.prepare(train, contract)).transform(ML.prepare(val, contract))
    want = M.roc_auc(alone.select("label", ML.positive_score(alone).alias("s")), "label", "s").first()[0]
    assert table["LogReg"].roc_auc == pytest.approx(want, abs=1e-3)
