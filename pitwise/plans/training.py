"""Train, calibrate, choose the operating threshold, evaluate once on test.

    snapshot -> temporal split -> check disjoint -> undersample train only
      -> GBT (cut to the best round by validation AUC) -> isotonic calibration on val
      -> threshold at target recall on val -> test metrics, FP reduction
      -> run record + serving artifacts (model, calibrator, contract)

All data work is Spark jobs; the driver only receives model parameters and a
handful of scalars (counts, the threshold).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.operators import metrics as M
from pitwise.operators.sampling import undersample
from pitwise.plans import models as ML
from pitwise.plans.contract import Contract
from pitwise.session import materialize

# Training defaults of the reference workflow.
NEG_PER_POS = 20
TARGET_RECALL = 0.80
RULES_PRECISION = 0.05
SEED = 42


@dataclass
class Trained:
    model: PipelineModel
    calibrator: IsotonicRegressionModel
    contract: Contract
    n_trees: int
    params: dict = field(default_factory=dict)
    fit_seconds: float = 0.0


def fit_gbt(train_bal: DataFrame, val: DataFrame, contract: Contract, max_iter: int = ML.BOOST_ITER,
            seed: int = SEED) -> tuple[PipelineModel, float | None]:
    """GBT on train, cut to the round with the best AUC on the validation rows, and that AUC; the preprocessing
    sees train only."""
    bal = materialize(ML.prepare(train_bal, contract), "train_bal")
    return ML.boost(bal, materialize(ML.prepare(val, contract), "val"), contract, max_iter=max_iter, seed=seed)


def raw_scores(model: PipelineModel, df: DataFrame, contract: Contract, keep=("transaction_id",)) -> DataFrame:
    pred = model.transform(ML.prepare(df, contract))
    keep = [c for c in keep if c in pred.columns]
    lab = [contract.label] if contract.label in pred.columns else []
    return pred.select(*keep, *lab, ML.positive_score(pred).alias("raw_score"))


def fit_calibrator(val_scores: DataFrame, label: str) -> IsotonicRegressionModel:
    """Isotonic map raw -> probability (ties pooled, constant outside the fitted range).

    Rows are pooled to one weighted row per score first: the fit merges its blocks on
    the driver, which then gets a row per distinct score.
    """
    iso = IsotonicRegression(featuresCol="raw_score", labelCol=label, predictionCol="fraud_probability", weightCol="__w")
    pooled = val_scores.groupBy("raw_score").agg(F.avg(F.col(label).cast("double")).alias(label),
                                                 F.count(F.lit(1)).cast("double").alias("__w"))
    return iso.fit(pooled)


def calibrate(cal: IsotonicRegressionModel, scores: DataFrame) -> DataFrame:
    return cal.transform(scores)


def train_and_calibrate(train: DataFrame, val: DataFrame, contract: Contract | None = None,
                        neg_per_pos: int = NEG_PER_POS, seed: int = SEED, max_iter: int = ML.BOOST_ITER,
                        target_recall: float = TARGET_RECALL) -> Trained:
    contract = contract or Contract()
    train_bal = undersample(train, contract.label, "transaction_id", neg_per_pos, seed)
    t0 = time.time()
    model, best_auc = fit_gbt(train_bal, val, contract, max_iter, seed)
    seconds = time.time() - t0
    val_raw = materialize(raw_scores(model, val, contract), "val_scores")
    cal = fit_calibrator(val_raw, contract.label)
    val_cal = calibrate(cal, val_raw)
    thr = M.pick_threshold(val_cal, contract.label, "fraud_probability", target_recall).first()[0]
    contract = Contract(contract.features, contract.cat_features, float(thr), contract.label)
    n_trees = len(model.stages[-1].trees)
    est = model.stages[-1]
    params = {"neg_per_pos": neg_per_pos, "seed": seed, "max_iter": max_iter, "target_recall": target_recall,
              "threshold": round(float(thr), 6), "trees": n_trees, "rules_precision": RULES_PRECISION,
              "learner": "GBTClassifier", "depth": est.getOrDefault("maxDepth"), "step_size": est.getOrDefault("stepSize"),
              "max_bins": est.getOrDefault("maxBins"), "loss": est.getOrDefault("lossType"),
              "best_iteration": n_trees, "best_val_auc": best_auc, "stale_rounds": ML.STALE_ROUNDS}
    return Trained(model, cal, contract, n_trees, params, seconds)


def score_frame(t: Trained, df: DataFrame, keep=("transaction_id",)) -> DataFrame:
    return calibrate(t.calibrator, raw_scores(t.model, df, t.contract, keep))


def evaluate(t: Trained, val: DataFrame, test: DataFrame, rules_precision: float = RULES_PRECISION) -> DataFrame:
    """One-row report: ranking on val (raw) and test (calibrated), operating point on test."""
    lab = t.contract.label
    v = materialize(score_frame(t, val), "val_scores")
    s = materialize(score_frame(t, test), "test_scores")
    conf = M.confusion(s, t.contract.threshold, lab, "fraud_probability")
    fpr = M.fp_reduction(conf, rules_precision).select("rules_fp", "fp_reduction", "alerts_per_fraud")
    parts = [
        M.roc_auc(v, lab, "raw_score").withColumnRenamed("roc_auc", "val_roc_auc"),
        M.average_precision(v, lab, "raw_score").withColumnRenamed("average_precision", "val_pr_auc"),
        M.roc_auc(s, lab, "fraud_probability").withColumnRenamed("roc_auc", "test_roc_auc"),
        M.average_precision(s, lab, "fraud_probability").withColumnRenamed("average_precision", "test_pr_auc"),
        conf.select(F.col("tp").alias("test_tp"), F.col("fp").alias("test_fp"), F.col("fn").alias("test_fn"),
                    F.col("recall").alias("test_recall"), F.col("precision").alias("test_precision")),
        fpr,
        M.calibration_means(s, lab).select(F.col("mean_calibrated").alias("test_mean_pred"),
                                           F.col("actual_rate").alias("test_actual_rate")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # all one-row frames
    return out.select(F.lit(float(t.contract.threshold)).alias("threshold"), F.lit(t.n_trees).alias("trees"), "*")


def save_artifacts(spark: SparkSession, t: Trained, path: str) -> None:
    """Serving contract: pipeline model, calibrator and feature contract side by side."""
    t.model.write().overwrite().save(f"{path}/model")
    t.calibrator.write().overwrite().save(f"{path}/calibrator")
    t.contract.save(spark, f"{path}/contract")


def load_artifacts(spark: SparkSession, path: str) -> Trained:
    model = PipelineModel.load(f"{path}/model")
    cal = IsotonicRegressionModel.load(f"{path}/calibrator")
    contract = Contract.load(spark, f"{path}/contract")
    return Trained(model, cal, contract, len(model.stages[-1].trees) if hasattr(model.stages[-1], "trees") else 0)


RUNS_SCHEMA = ("run_id string, started_utc string, snapshot_id string, "
               "params map<string,string>, metrics map<string,double>")


def log_run(spark: SparkSession, runs_path: str, params: dict, metrics: dict, snapshot_id: str = "") -> str:
    """Append one run record (params + metrics) to the Parquet `runs` table."""
    run_id = uuid.uuid4().hex
    row = (run_id, datetime.now(timezone.utc).isoformat(), snapshot_id,
           {k: str(v) for k, v in params.items()},
           {k: (float(v) if v is not None else None) for k, v in metrics.items()})
    spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(runs_path)
    return run_id


def report_to_metrics(report: DataFrame) -> dict:
    """The one-row report as a dict (one small row to the driver)."""
    r = report.first().asDict()
    return {k: v for k, v in r.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}


def leaderboard(train_bal: DataFrame, val: DataFrame, contract: Contract | None = None, seed: int = SEED,
                target_recall: float = TARGET_RECALL, gbt_iter: int = ML.BOOST_ITER, rf_trees: int = ML.BOOST_ITER,
                linear_iter: int = ML.LINEAR_ITER, booster: Trained | None = None) -> DataFrame:
    """Four classifiers fitted on the balanced train split, ranked on val by precision
    at the target recall; ROC AUC and average precision alongside, fit seconds.

    `booster`: a fitted booster of the same rows, taken as it is. The scores of all models are written as one
    table, and the three metrics of all come from one pass over it.
    """
    contract = contract or Contract()
    spark = train_bal.sparkSession
    lab = contract.label
    tb = materialize(ML.prepare(train_bal, contract), "train_bal")
    n = tb.count()
    tb = materialize(ML.sized(tb, n), "train_sized")  # every fit passes over it several times
    va = materialize(ML.prepare(val, contract), "val")
    candidates = [
        ("RandomForest", lambda: ML.fit_forest(tb, contract, rf_trees, seed=seed), "probability"),
        ("LogReg", lambda: linear(ML.logistic_regression(contract, n, linear_iter)), "probability"),
        ("LinearSVC", lambda: linear(ML.linear_svc(contract, n, linear_iter)), "raw"),
    ]
    prepared: list = []

    def linear(est):
        if not prepared:  # shared by the linear models, in the seconds of the first
            prepared.append(ML.linear_preparation(tb, contract))
        prep, ready = prepared[0]
        return PipelineModel([*prep.stages, est.fit(ready)])

    if booster is None:
        candidates.insert(0, ("GBT", lambda: ML.boost(tb, va, contract, max_iter=gbt_iter, seed=seed)[0], "probability"))
    fitted = [("GBT", booster.model, "probability", booster.fit_seconds)] if booster is not None else []
    for name, fit, kind in candidates:
        t0 = time.time()
        fitted.append((name, fit(), kind, time.time() - t0))
    scores = None
    for name, model, kind, _ in fitted:
        pred = model.transform(va)
        one = pred.select(F.lit(name).alias("model"), F.col(lab).cast("int").alias(lab), ML.positive_score(pred, kind).alias("s"))
        scores = one if scores is None else scores.unionByName(one)
    col = f"prec_at_rec{int(round(target_recall * 100))}"
    seconds = spark.createDataFrame([(f[0], round(f[3], 1)) for f in fitted], "model string, fit_s double")  # a row a model
    table = M.grouped_ranking(scores, "model", lab, "s", target_recall).join(F.broadcast(seconds), "model")
    known = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 4)
    return table.select("model", known("roc_auc").alias("roc_auc"), known("average_precision").alias("pr_auc"),
                        known("precision_at_recall").alias(col), "fit_s").orderBy(F.desc(col), "model")
