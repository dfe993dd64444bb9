"""Keyed queries: model training, calibration, comparison, attribution, run log,
contract validation and batch / stream scoring.

Models are fitted once per (session, tables of the data directory) and shared by these keys. The tables they
share are written to folders of this module's own, which `session.drop_scratch` leaves alone and
`drop_shared` deletes. Results that depend on learned parameters are checked on row counts only; the rows
a model accepts, and the parameters a run records, have an oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise import oracles as O
from pitwise.operators.sampling import undersample
from pitwise.operators.splits import assert_disjoint, temporal_split
from pitwise.plans import attribution as A
from pitwise.plans import models as ML
from pitwise.plans import training as TR
from pitwise.plans.contract import Contract, rejection_counts, validate
from pitwise.plans.matrix import operations
from pitwise.plans.queries_eval import CUTS_CTE, SEED, _matrix
from pitwise.plans.scoring import score
from pitwise.plans.snapshot import DATASET, build_snapshot
from pitwise.registry import query
from pitwise.session import delete_paths, materialize, new_scratch, unique_path
from pitwise.sources.fixtures import RAW_TABLES, raw_path
from pitwise.sources.snapshots import load_snapshot
from pitwise.streaming.scoring import run_to_completion, start_scoring_stream

_CACHE: dict = {}
_SHARED: list[str] = []


def _shared_path(spark, name: str) -> str:
    _SHARED.append(unique_path(spark, name))
    return _SHARED[-1]


def _keep(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a folder that lives until `drop_shared`."""
    path = _shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_shared(spark) -> int:
    """Forget the fitted models and shared tables and delete their folders; returns the number deleted."""
    _CACHE.clear()
    paths = list(_SHARED)
    _SHARED.clear()
    return delete_paths(spark, paths)


def _key(t, what: str) -> tuple:
    """Per application and state of all tables read: changed data or a new session are fitted anew.

    One job lists the files of all tables; their contents are not read.
    """
    each = [t.spark.read.format("binaryFile").load(raw_path(t.sf_dir, name)).select("path", "modificationTime", "length")
            for name in RAW_TABLES]
    state = reduce(DataFrame.union, each).agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()
    return what, t.spark.sparkContext.applicationId, t.sf_dir, tuple(state)


def _once(t, what: str, make):
    key = _key(t, what)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


def _snapshot(t):
    """(data, manifest, id) of a snapshot that is built, published and loaded by its id."""
    def make():
        root = _shared_path(t.spark, "training")
        made, _, _ = build_snapshot(t.spark, operations(t.transactions), t.fraud_labels, t.merchants, root=root)
        return load_snapshot(t.spark, root, DATASET, made)
    return _once(t, "snapshot", make)


def _parts(t):
    """The frozen snapshot cut at the dates of its manifest."""
    def make():
        data, manifest, _ = _snapshot(t)
        split = temporal_split(data, t.spark.createDataFrame([manifest["split"]], "train_end string, val_end string"))
        assert_disjoint(split)  # train <= val <= test in time, or stop here
        return {p: _keep(split.filter(F.col("split") == p).drop("split"), p) for p in ("train", "val", "test")}
    return _once(t, "parts", make)


def _trained(t) -> TR.Trained:
    def make():
        p = _parts(t)
        return TR.train_and_calibrate(p["train"], p["val"], Contract())
    return _once(t, "gbt", make)


@query("train_gbt")
def q_train_gbt(t):
    """Training report: trees kept, threshold, val/test ranking, test operating point."""
    p = _parts(t)
    return TR.evaluate(_trained(t), p["val"], p["test"])


@query("isotonic_calibration")
def q_isotonic_calibration(t):
    """Validation rows: raw score and calibrated probability."""
    return TR.score_frame(_trained(t), _parts(t)["val"])


@query("calibration_means")
def q_calibration_means(t):
    from pitwise.operators.metrics import calibration_means
    return calibration_means(TR.score_frame(_trained(t), _parts(t)["val"]))


@query("model_leaderboard")
def q_model_leaderboard(t):
    p = _parts(t)
    return TR.leaderboard(undersample(p["train"], seed=SEED), p["val"], booster=_trained(t))


@query("attribution_global")
def q_attribution_global(t):
    """Mean |contribution|, direction and rank of every feature (linear model, whole test split)."""
    p = _parts(t)
    c = Contract()
    bal = materialize(undersample(p["train"], seed=SEED), "train_bal")
    lr = ML.logistic(c, bal.count()).fit(ML.prepare(bal, c))
    contrib = A.linear_contributions(lr, bal, p["test"], c)
    return A.global_importance(contrib, c)


@query("importance_trees")
def q_importance_trees(t):
    """Permutation importance of every feature of the boosted trees, over the test split."""
    return A.permutation_importance(_trained(t).model, _parts(t)["test"], Contract())


@query("run_log")
def q_run_log(t):
    """Append one run record (lineage, params, test metrics) and read the runs table back."""
    tr = _trained(t)
    p = _parts(t)
    metrics = TR.report_to_metrics(TR.evaluate(tr, p["val"], p["test"]))
    runs = new_scratch(t.spark, "runs")
    _, manifest, snapshot_id = _snapshot(t)
    lineage = {"dataset_sha256": manifest["sha256"], "rows": manifest["rows"], **manifest["recipe"], **manifest["split"]}
    TR.log_run(t.spark, runs, {**lineage, **tr.params}, metrics, snapshot_id)
    return t.spark.read.parquet(runs)


def _all_rows(t):
    p = _parts(t)
    return p["train"].unionByName(p["val"]).unionByName(p["test"])


@query("score_batch")
def q_score_batch(t):
    """Save the serving artifacts, load them back, score every row of the matrix."""
    path = new_scratch(t.spark, "artifacts")
    TR.save_artifacts(t.spark, _trained(t), path)
    served = TR.load_artifacts(t.spark, path)
    scored, _ = score(_all_rows(t), served)
    return scored


@query("score_stream")
def q_score_stream(t):
    """All rows of the matrix as a file stream, scored micro-batch by micro-batch."""
    tr = _trained(t)
    rows = _all_rows(t)
    base = new_scratch(t.spark, "stream")
    rows.write.parquet(f"{base}/in")
    qs = start_scoring_stream(t.spark, f"{base}/in", rows.schema, tr, f"{base}/out", f"{base}/ckpt",
                              rejected_dir=f"{base}/rejected")
    run_to_completion(qs)
    return t.spark.read.parquet(f"{base}/out")


def _sound(scored: DataFrame) -> DataFrame:
    """The rows a scoring gives, and whether each is what the contract says: a probability, flagged from the threshold on."""
    p, edge = F.col("fraud_probability"), F.abs(F.col("fraud_probability") - F.col("threshold")) <= 1e-6  # rounded to 6 digits
    sound = p.between(0, 1) & F.col("raw_score").between(0, 1) & ((F.col("flag") == (p >= F.col("threshold"))) | edge)
    return scored.select("transaction_id", "customer_id", "authorized_at", sound.alias("sound"))


SCORED_ROWS = O.sql("""
SELECT transaction_id, customer_id, authorized_at, true AS sound FROM matrix
WHERE channel IS NOT NULL AND entry_mode IS NOT NULL AND country IS NOT NULL AND mcc IS NOT NULL AND risk_segment IS NOT NULL
""", *O.matrix_ctes())


@query("score_batch_rows", SCORED_ROWS)
def q_score_batch_rows(t):
    """Row set and flags of the batch scoring."""
    return _sound(q_score_batch(t))


@query("score_stream_rows", SCORED_ROWS)
def q_score_stream_rows(t):
    """Row set and flags of the stream scoring: every row once, over all micro-batches."""
    return _sound(q_score_stream(t))


@query("run_log_lineage", O.sql("""
SELECT 1 AS runs, substr(f.sha256, 1, 12) AS snapshot_suffix, CAST(f.n_rows AS VARCHAR) AS rows, f.sha256 AS dataset_sha256,
  strftime(b.now_ts, '%Y-%m-%d %H:%M:%S') AS now_ts, strftime(b.tx_cutoff, '%Y-%m-%d %H:%M:%S') AS transaction_cutoff,
  '90' AS maturity_window_days, CAST(c.train_end AS VARCHAR) AS train_end, CAST(c.val_end AS VARCHAR) AS val_end,
  '20' AS neg_per_pos, '42' AS seed, '0.8' AS target_recall, '800' AS max_iter, '50' AS stale_rounds, true AS stopped_in_budget
FROM fingerprint f, bounds b, cuts c""", *O.matrix_ctes(), CUTS_CTE, O.FINGERPRINT_CTE))
def q_run_log_lineage(t):
    """What a run record says of its data and parameters."""
    runs = q_run_log(t)
    p = F.col("params")
    stopped = (p["best_iteration"].cast("int").between(1, 800)) & p["best_val_auc"].cast("double").between(0, 1)
    names = ("rows", "dataset_sha256", "now_ts", "transaction_cutoff", "maturity_window_days", "train_end", "val_end", "neg_per_pos",
             "seed", "target_recall", "max_iter", "stale_rounds")
    return runs.select(F.lit(1).alias("runs"), F.substring_index("snapshot_id", "_", -1).alias("snapshot_suffix"),
                       *[p[n].alias(n) for n in names], stopped.alias("stopped_in_budget"))


# Rules by which requests are spoiled: column -> (ids whose remainder by the first number is the second, sent text).
SPOILED = {
    "channel": (89, 1, None), "entry_mode": (97, 2, None), "country": (101, 3, None), "mcc": (103, 4, None),
    "risk_segment": (107, 5, None), "amount": (109, 6, "ten"), "vel_24h": (113, 7, "1,5"), "merchant_fraud_rate_pit": (127, 8, ""),
    "secs_since_prev": (11, 9, None), "hour": (13, 10, " 7 "),  # a missing number is valid, and so is one with blanks
}


def _requests(t) -> DataFrame:
    """Every row of the matrix as a scoring request, fields as text, some spoiled by rule."""
    rows = _matrix(t)
    sent = lambda c: F.col(c).cast("string")
    put = {c: F.when(F.pmod("transaction_id", F.lit(n)) == k, F.lit(text)).otherwise(sent(c)).alias(c)
           for c, (n, k, text) in SPOILED.items()}
    return rows.select("transaction_id", *[put.get(c, sent(c).alias(c)) for c in Contract().features])


def _validation_sql() -> str:
    contract = Contract()
    hit = lambda c: f"transaction_id % {SPOILED[c][0]} = {SPOILED[c][1]}"
    reasons = [f"CASE WHEN {hit(c) if c in SPOILED else 'false'} OR {c} IS NULL THEN 'missing:{c}' END" for c in contract.cat_features]
    reasons += [f"CASE WHEN {hit(c)} THEN 'not_numeric:{c}' END" for c in ("amount", "vel_24h", "merchant_fraud_rate_pit")]
    return f"""
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM (
  SELECT unnest(CASE WHEN len(list_filter(reasons, lambda x: x IS NOT NULL)) = 0 THEN [NULL]
                     ELSE list_filter(reasons, lambda x: x IS NOT NULL) END) AS reason
  FROM (SELECT [{', '.join(reasons)}] AS reasons FROM matrix))
GROUP BY ALL"""


@query("contract_validation", O.sql(_validation_sql(), *O.matrix_ctes()))
def q_contract_validation(t):
    """All rows of the matrix as scoring requests, some spoiled: accepted count and rejections per reason."""
    ok, bad = validate(_requests(t), Contract())
    acc = ok.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("reason"), "n")
    return acc.unionByName(rejection_counts(bad))
