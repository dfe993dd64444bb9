"""Keyed queries: snapshot statistics, temporal split, sampling, fingerprint and
the exact evaluation metrics.

Ranking metrics are evaluated on the validation split with a single-feature
score (the operation amount, a rules-style baseline); calibration tables use the
point-in-time merchant fraud rate, which is a probability. Model-based versions of
the same metrics run in the training plan (rows-only checks).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwise import oracles as O
from pitwise.operators import metrics as M
from pitwise.operators.fingerprint import content_fingerprint
from pitwise.operators.labels import label_assembly, maturity_gate
from pitwise.operators.sampling import capped_sample, undersample
from pitwise.operators.splits import cut_points, split_check, split_summary, temporal_split
from pitwise.plans.matrix import feature_matrix, operations
from pitwise.plans.snapshot import DATASET, build_snapshot, dataset_stats, publish
from pitwise.registry import query
from pitwise.session import materialize, new_scratch
from pitwise.sources import snapshots as S

TARGET_RECALL = 0.80   # fixed value: recall the rules engine guarantees
RULES_PRECISION = 0.05  # fixed value: assumed rules precision at that recall
NEG_PER_POS = 20
SEED = 42
SAMPLE_CAP = 1000


PLAIN_COLUMNS = {"transaction_id", "customer_id", "authorized_at", "amount", "label"}
SCORE_COLUMNS = ["transaction_id", "authorized_at", "label", "amount"]


def _matrix(t, cols: list[str] | None = None, tx=None):
    # several passes (counts, quantiles, ranking) read the matrix: write it once (only
    # the columns the query needs) and read the frozen copy
    if cols and set(cols) <= PLAIN_COLUMNS:
        # operations and their label: no windows, weekly rates or merchants are needed
        tx = t.transactions.select(*{"transaction_id", "authorized_at", *cols} - {"label"})
        rows = label_assembly(tx, t.fraud_labels) if "label" in cols else maturity_gate(tx)
        return materialize(rows.select(*cols), "matrix")
    m = feature_matrix(operations(t.transactions) if tx is None else tx, t.fraud_labels, t.merchants)
    return materialize(m.select(*cols) if cols else m, "matrix")


def _split(t, cols: list[str] | None = None):
    return temporal_split(_matrix(t, cols))


def _scored(t, part: str):
    return (_split(t, SCORE_COLUMNS).filter(F.col("split") == part)
            .withColumn("score", F.col("amount").cast("double")))


# ------------------------------------------------------------------ oracle pieces

CUTS_CTE = """
cuts AS (SELECT quantile_cont(authorized_at, 0.7) AS train_end, quantile_cont(authorized_at, 0.85) AS val_end
         FROM matrix)"""
SPLIT_CTE = """
splitm AS (
  SELECT m.*, CASE WHEN m.authorized_at <= c.train_end THEN 'train'
                   WHEN m.authorized_at <= c.val_end THEN 'val' ELSE 'test' END AS split
  FROM matrix m CROSS JOIN cuts c)"""


def _eval_ctes(part: str = "val"):
    return (*O.matrix_ctes(), CUTS_CTE, SPLIT_CTE, f"""
scored AS (SELECT label, CAST(amount AS DOUBLE) AS score FROM splitm WHERE split = '{part}')""", """
tot AS (SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label <> 1) AS N FROM scored)""", """
curve AS (
  SELECT score AS threshold, pos, neg,
    CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
  FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
        FROM scored GROUP BY score) g)""")


PICK_SQL = f"""
SELECT coalesce(max(CASE WHEN CAST(tp AS DOUBLE) / CAST(tot.P AS DOUBLE) >= {TARGET_RECALL} THEN threshold END),
                min(threshold)) AS threshold
FROM curve CROSS JOIN tot"""

# ------------------------------------------------------------------ snapshot statistics


@query("dataset_stats", O.sql("""
SELECT count(*) AS rows, CAST(coalesce(sum(label), 0) AS BIGINT) AS positives,
  round(coalesce(CAST(sum(label) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0), 0.0), 6) AS fraud_rate
FROM matrix""", *O.matrix_ctes()))
def q_dataset_stats(t):
    return dataset_stats(_matrix(t, ["label"]))


@query("temporal_cut_points", O.sql("SELECT train_end, val_end FROM cuts", *O.matrix_ctes(), CUTS_CTE))
def q_temporal_cut_points(t):
    return cut_points(_matrix(t, ["authorized_at"]))


@query("temporal_split", O.sql("SELECT transaction_id, split FROM splitm", *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_temporal_split(t):
    return _split(t, ["transaction_id", "authorized_at"]).select("transaction_id", "split")


@query("split_summary", O.sql("""
SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives,
  round(CAST(sum(label) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS fraud_rate,
  min(authorized_at) AS min_ts, max(authorized_at) AS max_ts
FROM splitm GROUP BY split""", *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_split_summary(t):
    return split_summary(_split(t, ["authorized_at", "label"]))


@query("split_check", O.sql("""
SELECT train_max, val_min, val_max, test_min,
  coalesce(train_max <= val_min, true) AS train_before_val, coalesce(val_max <= test_min, true) AS val_before_test,
  coalesce(train_max <= val_min, true) AND coalesce(val_max <= test_min, true) AS ok
FROM (SELECT max(authorized_at) FILTER (WHERE split = 'train') AS train_max,
             max(authorized_at) FILTER (WHERE split = 'val') AS val_max,
             min(authorized_at) FILTER (WHERE split = 'val') AS val_min,
             min(authorized_at) FILTER (WHERE split = 'test') AS test_min FROM splitm) x""",
    *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_split_check(t):
    return split_check(_split(t, ["authorized_at"]))


@query("content_fingerprint", O.sql("SELECT n_rows, sha256 FROM fingerprint", *O.matrix_ctes(), O.FINGERPRINT_CTE))
def q_content_fingerprint(t):
    """Order-free sha256 of the feature matrix."""
    return content_fingerprint(_matrix(t))


@query("snapshot_manifest", O.sql("""
SELECT s.rows, s.positives, s.fraud_rate, strftime(b.now_ts, '%Y-%m-%d %H:%M:%S') AS now_ts,
  strftime(b.tx_cutoff, '%Y-%m-%d %H:%M:%S') AS transaction_cutoff, 90 AS maturity_window_days,
  'weekly' AS merchant_rate_granularity, CAST(c.train_end AS VARCHAR) AS train_end, CAST(c.val_end AS VARCHAR) AS val_end,
  18 AS n_feature_columns, 'label' AS label_column
FROM (SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives,
             round(CAST(sum(label) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS fraud_rate FROM matrix) s
CROSS JOIN bounds b CROSS JOIN cuts c""", *O.matrix_ctes(), CUTS_CTE))
def q_snapshot_manifest(t):
    """Scalar part of a dry-run snapshot manifest (nothing written)."""
    _, man, _ = build_snapshot(t.spark, operations(t.transactions), t.fraud_labels, t.merchants, root="unused", dry_run=True)
    return man.select("rows", "positives", "fraud_rate", "recipe.now_ts", "recipe.transaction_cutoff",
                      "recipe.maturity_window_days", "recipe.merchant_rate_granularity", "split.train_end",
                      "split.val_end", F.size("feature_columns").alias("n_feature_columns"), "label_column")


@query("snapshot_write", O.sql("SELECT * FROM matrix", *O.matrix_ctes()))
def q_snapshot_write(t):
    """Freeze the matrix under a fresh id in the shared scratch folder; read it back."""
    _, _, data = build_snapshot(t.spark, operations(t.transactions), t.fraud_labels, t.merchants,
                                 root=new_scratch(t.spark, "snapshots"))
    return data


@query("snapshot_publish", O.sql("""
SELECT unnest([1, 2]) AS publish, n_rows AS rows, substr(sha256, 1, 12) AS suffix, 1 AS data_folders FROM fingerprint""",
                                 *O.matrix_ctes(), O.FINGERPRINT_CTE))
def q_snapshot_publish(t):
    """The same content published twice, with a killed attempt between: one suffix, one data folder, two ids."""
    root = new_scratch(t.spark, "snapshots")
    tx = operations(t.transactions)
    matrix = _matrix(t, tx=tx)
    for k in range(2):
        publish(t.spark, matrix, tx, root, now=datetime(2024, 1, 1 + k, tzinfo=timezone.utc))
        S.write_data(matrix.limit(1), root, DATASET, S.new_object_id())  # an attempt that ended before its manifest
    found = S.manifests(t.spark, root, DATASET)
    folders = found.select("data_path").distinct().count()
    return found.select(F.row_number().over(Window.orderBy("snapshot_id")).alias("publish"), "rows",
                        F.substring_index("snapshot_id", "_", -1).alias("suffix"), F.lit(folders).alias("data_folders"))


# ------------------------------------------------------------------ sampling


@query("undersample", O.sql(f"""
SELECT transaction_id, label FROM splitm WHERE split = 'train' AND label = 1
UNION ALL
SELECT transaction_id, label FROM (
  SELECT transaction_id, label,
    row_number() OVER (ORDER BY md5('{SEED}:' || CAST(transaction_id AS VARCHAR)), transaction_id) AS rn
  FROM splitm WHERE split = 'train' AND label = 0) n
WHERE rn <= (SELECT least(count(*) FILTER (WHERE label = 0), {NEG_PER_POS} * count(*) FILTER (WHERE label = 1))
             FROM splitm WHERE split = 'train')""", *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_undersample(t):
    train = _split(t, ["transaction_id", "authorized_at", "label"]).filter(F.col("split") == "train")
    return undersample(train, neg_per_pos=NEG_PER_POS, seed=SEED).select("transaction_id", "label")


@query("capped_sample", O.sql(f"""
SELECT transaction_id FROM (
  SELECT transaction_id,
    row_number() OVER (ORDER BY md5('{SEED}:' || CAST(transaction_id AS VARCHAR)), transaction_id) AS rn
  FROM splitm WHERE split = 'test') x
WHERE rn <= {SAMPLE_CAP}""", *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_capped_sample(t):
    test = _split(t, ["transaction_id", "authorized_at"]).filter(F.col("split") == "test")
    return capped_sample(test, SAMPLE_CAP, "transaction_id", SEED).select("transaction_id")


# ------------------------------------------------------------------ ranking metrics


@query("pr_curve", O.sql("""
SELECT threshold, tp, fp, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
  CASE WHEN tot.P = 0 THEN 1.0::DOUBLE ELSE CAST(tp AS DOUBLE) / CAST(tot.P AS DOUBLE) END AS recall
FROM curve CROSS JOIN tot""", *_eval_ctes()))
def q_pr_curve(t):
    return M.pr_curve(_scored(t, "val"))


@query("roc_auc", O.sql("""
SELECT round(CAST(sum(2::HUGEINT * pos * (tot.N - fp) + pos::HUGEINT * neg) AS DOUBLE) / (2.0::DOUBLE * max(tot.P) * max(tot.N)), 6)
  AS roc_auc
FROM curve CROSS JOIN tot""", *_eval_ctes()))
def q_roc_auc(t):
    return M.roc_auc(_scored(t, "val"))


@query("average_precision", O.sql("""
SELECT round(sum(CAST(pos AS DOUBLE) * CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) / CAST(max(tot.P) AS DOUBLE), 6)
  AS average_precision
FROM curve CROSS JOIN tot""", *_eval_ctes()))
def q_average_precision(t):
    return M.average_precision(_scored(t, "val"))


@query("pick_threshold", O.sql(PICK_SQL, *_eval_ctes()))
def q_pick_threshold(t):
    return M.pick_threshold(_scored(t, "val"), target_recall=TARGET_RECALL)


@query("precision_at_recall", O.sql(f"""
SELECT round(coalesce(max(CASE WHEN CAST(tp AS DOUBLE) / CAST(tot.P AS DOUBLE) >= {TARGET_RECALL}
                               THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END), 0.0), 6) AS precision_at_recall
FROM curve CROSS JOIN tot""", *_eval_ctes()))
def q_precision_at_recall(t):
    return M.precision_at_recall(_scored(t, "val"), target_recall=TARGET_RECALL)


CONF_SQL = f"""
conf AS (
  SELECT count(*) FILTER (WHERE score >= thr AND label = 1) AS tp,
         count(*) FILTER (WHERE score >= thr AND label <> 1) AS fp,
         count(*) FILTER (WHERE score < thr AND label = 1) AS fn
  FROM (SELECT label, CAST(amount AS DOUBLE) AS score FROM splitm WHERE split = 'test') x
  CROSS JOIN ({PICK_SQL}) p(thr))"""


def _test_confusion(t):
    split = _split(t, SCORE_COLUMNS)
    score = lambda part: split.filter(F.col("split") == part).withColumn("score", F.col("amount").cast("double"))
    thr = M.pick_threshold(score("val"), target_recall=TARGET_RECALL).first()[0]  # one number
    return M.confusion(score("test"), thr)


@query("confusion", O.sql("""
SELECT tp, fp, fn,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0), 6) AS recall,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0), 6) AS precision
FROM conf""", *_eval_ctes(), CONF_SQL))
def q_confusion(t):
    """Threshold picked on validation at the target recall, applied once to test."""
    return _test_confusion(t)


@query("fp_reduction", O.sql(f"""
SELECT tp, fp, round(CAST(tp AS DOUBLE) / {RULES_PRECISION} - CAST(tp AS DOUBLE), 4) AS rules_fp,
  round(CASE WHEN CAST(tp AS DOUBLE) / {RULES_PRECISION} - CAST(tp AS DOUBLE) > 0
             THEN 1.0 - CAST(fp AS DOUBLE) / (CAST(tp AS DOUBLE) / {RULES_PRECISION} - CAST(tp AS DOUBLE)) END, 6)
    AS fp_reduction,
  round(CASE WHEN tp > 0 THEN CAST(tp + fp AS DOUBLE) / CAST(tp AS DOUBLE) ELSE 0.0 END, 4) AS alerts_per_fraud
FROM conf""", *_eval_ctes(), CONF_SQL))
def q_fp_reduction(t):
    return M.fp_reduction(_test_confusion(t), RULES_PRECISION)


@query("reliability", O.sql("""
SELECT CAST(len(list_filter(list_slice(e.edges, 2, greatest(len(e.edges) - 1, 1)), lambda x: x <= s.p)) AS INTEGER) AS bin,
  count(*) AS n, round(avg(s.p), 6) AS mean_pred, round(avg(CAST(s.label AS DOUBLE)), 6) AS observed_rate
FROM (SELECT label, merchant_fraud_rate_pit AS p FROM splitm WHERE split = 'test' AND merchant_fraud_rate_pit IS NOT NULL) s
CROSS JOIN (SELECT list_distinct_ordered AS edges FROM (
  SELECT list_sort(list_distinct(quantile_cont(merchant_fraud_rate_pit, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))
    AS list_distinct_ordered
  FROM splitm WHERE split = 'test' AND merchant_fraud_rate_pit IS NOT NULL)) e
GROUP BY 1""", *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_reliability(t):
    """Calibration table of the point-in-time merchant rate read as a probability."""
    test = _split(t, ["authorized_at", "label", "merchant_fraud_rate_pit"]).filter(F.col("split") == "test")
    return M.reliability(test, prob="merchant_fraud_rate_pit")


NUMERIC_FEATURES = ["amount", "hour", "is_ecommerce", "is_recurring", "is_tokenized", "ip_mismatch", "vel_1h",
                    "vel_24h", "vel_7d", "secs_since_prev", "amount_z", "decline_rate_20", "merchant_fraud_rate_pit"]


@query("feature_direction", O.sql("\nUNION ALL\n".join(
    f"""SELECT '{f}' AS feature, count(CASE WHEN {f} IS NOT NULL THEN 1 END) AS n,
  round(CASE WHEN count(CASE WHEN {f} IS NOT NULL THEN 1 END) > 10 AND stddev_pop(CAST({f} AS DOUBLE)) > 0
             THEN corr(CAST({f} AS DOUBLE), CAST(label AS DOUBLE)) END, 6) AS r,
  CASE WHEN count(CASE WHEN {f} IS NOT NULL THEN 1 END) > 10 AND stddev_pop(CAST({f} AS DOUBLE)) > 0 THEN
    CASE WHEN corr(CAST({f} AS DOUBLE), CAST(label AS DOUBLE)) > 0.05 THEN 'up'
         WHEN corr(CAST({f} AS DOUBLE), CAST(label AS DOUBLE)) < -0.05 THEN 'down' ELSE 'mixed' END END AS direction
FROM splitm WHERE split = 'test'""" for f in NUMERIC_FEATURES), *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_feature_direction(t):
    """Direction of each numeric feature against the label on the test split."""
    test = _split(t).filter(F.col("split") == "test")
    return M.feature_direction(test, NUMERIC_FEATURES, "label")


@query("undersample_rates", O.sql(f"""
SELECT rows_before, rows_after, pos_before,
  round(CAST(pos_before AS DOUBLE) / CAST(rows_before AS DOUBLE), 6) AS rate_before,
  round(CAST(pos_before AS DOUBLE) / CAST(rows_after AS DOUBLE), 6) AS rate_after,
  round((CAST(pos_before AS DOUBLE) / CAST(rows_after AS DOUBLE))
        / (CAST(pos_before AS DOUBLE) / CAST(rows_before AS DOUBLE)), 4) AS prior_shift
FROM (SELECT count(*) AS rows_before, CAST(sum(label) AS BIGINT) AS pos_before,
        CAST(sum(label) AS BIGINT)
          + least(count(*) FILTER (WHERE label = 0), {NEG_PER_POS} * count(*) FILTER (WHERE label = 1)) AS rows_after
      FROM splitm WHERE split = 'train') x""", *O.matrix_ctes(), CUTS_CTE, SPLIT_CTE))
def q_undersample_rates(t):
    """Fraud rate before / after undersampling the train split and the prior shift."""
    from pitwise.operators.sampling import undersample_rates

    train = _split(t, ["transaction_id", "authorized_at", "label"]).filter(F.col("split") == "train")
    return undersample_rates(train, undersample(train, neg_per_pos=NEG_PER_POS, seed=SEED))
