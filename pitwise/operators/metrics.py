"""Exact ranking, threshold and calibration metrics as Spark aggregates.

The curve behind ROC AUC, average precision and the precision/recall curve is one
row per distinct score with cumulative true/false positives in descending score
order. Ties share one threshold, as in the usual definitions:

* `roc_auc`           Mann-Whitney: P(score_pos > score_neg) + 0.5 P(tie),
* `average_precision` sum over thresholds of (R_k - R_{k-1}) * P_k (step, no
                      interpolation; this is not Spark's `areaUnderPR`),
* `pick_threshold`    highest threshold whose recall >= target (else the lowest),
* `precision_at_recall` best precision among thresholds with recall >= target.

The input is read once, into a written table of one row per distinct score; totals, bucket bounds and
the running sums (`running_sums`, over key-range buckets) read that table. No curve is collected. Rows with a
NULL score are ignored.

`grouped_ranking` computes the same metrics for many groups (models, iterations, permuted features) in one
pass, each group's curve being cut by score ranges like a single one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.operators.carry import carried
from pitwise.operators.ordering import _bucket, running_sums
from pitwise.operators.quantiles import exact_quantiles
from pitwise.session import materialize


def _scored(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.select(F.col(label).cast("int").alias("__y"), F.col(score).cast("double").alias("__s")) \
        .filter(F.col("__s").isNotNull())


def _per_score(df: DataFrame, label: str, score: str, *group: str) -> DataFrame:
    """(group, __s, pos, neg), written: one row per distinct score."""
    src = df.select(*group, F.col(label).cast("int").alias("__y"), F.col(score).cast("double").alias("__s"))
    return materialize(src.filter(F.col("__s").isNotNull()).groupBy(*group, "__s").agg(
        F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") != 1).alias("neg")), "scores")


def score_curve(df: DataFrame, label: str = "label", score: str = "score",
                num_buckets: int | None = None) -> DataFrame:
    """(threshold, pos, neg, tp, fp): one row per distinct score, tp/fp = rows with score >= threshold."""
    cum = running_sums(_per_score(df, label, score), [F.col("__s").desc()], ["pos", "neg"], num_buckets,
                       bucket_key=F.col("__s"), descending=True)
    return cum.select(F.col("__s").alias("threshold"), "pos", "neg",
                      F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"))


def class_totals(curve: DataFrame) -> tuple[Column, Column]:
    """Number of positives and negatives of a curve (two counts come back to the driver and are
    used as literals; scores from model UDFs cannot feed a scalar subquery)."""
    p, n = curve.agg(F.sum("pos"), F.sum("neg")).first()
    return F.lit(int(p or 0)), F.lit(int(n or 0))


def _curve(df: DataFrame, label: str, score: str) -> tuple[DataFrame, Column, Column]:
    curve = score_curve(df, label, score)
    return curve, *class_totals(curve)


def _recall(tp: Column, P: Column) -> Column:
    # with no positives every threshold has full recall (by convention)
    return F.when(P == 0, F.lit(1.0)).otherwise(tp.cast("double") / P.cast("double"))


def _precision() -> Column:
    return F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")


def _best_precision(P: Column, target_recall: float) -> Column:
    best = F.max(F.when(_recall(F.col("tp"), P) >= F.lit(float(target_recall)), _precision()))
    if target_recall <= 0:  # the curve's end point (recall 0, precision 1) qualifies too
        best = F.greatest(best, F.lit(1.0))
    return F.round(F.coalesce(best, F.lit(0.0)), 6)


def _misranked() -> Column:
    """Sum of pos * (2 * negatives above + tied negatives), exactly: twice the pairs ranked wrong, ties as half.

    The counts are DECIMAL(19,0) before they are multiplied: neither INT nor LONG holds the product of two counts.
    """
    exact = lambda x: x.cast("decimal(19,0)")
    wrong = (exact(F.lit(2)) * exact(F.col("fp")) - exact(F.col("neg"))).cast("decimal(19,0)")
    return F.sum((exact(F.col("pos")) * wrong).cast("decimal(38,0)"))


def _auc(misranked: Column, P: Column, N: Column) -> Column:
    pairs = F.lit(2).cast("decimal(19,0)") * (P.cast("decimal(19,0)") * N.cast("decimal(18,0)")).cast("decimal(37,0)")
    right = (pairs - misranked).cast("double")
    return F.round(F.try_divide(right, pairs.cast("double")), 6)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c, P, _ = _curve(df, label, score)
    return c.select("threshold", "tp", "fp", _precision().alias("precision"), _recall(F.col("tp"), P).alias("recall"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c, P, N = _curve(df, label, score)
    return c.agg(_misranked().alias("__w")).select(_auc(F.col("__w"), P, N).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c, P, _ = _curve(df, label, score)
    return c.agg(F.sum(F.col("pos").cast("double") * _precision()).alias("__s")).select(
        F.round(F.try_divide(F.col("__s"), P.cast("double")), 6).alias("average_precision"))


def pick_threshold(df: DataFrame, label: str = "label", score: str = "score", target_recall: float = 0.8) -> DataFrame:
    c, P, _ = _curve(df, label, score)
    ok = _recall(F.col("tp"), P) >= F.lit(float(target_recall))
    return c.agg(F.coalesce(F.max(F.when(ok, F.col("threshold"))), F.min("threshold")).alias("threshold"))


def precision_at_recall(df: DataFrame, label: str = "label", score: str = "score",
                        target_recall: float = 0.8) -> DataFrame:
    c, P, _ = _curve(df, label, score)
    return c.agg(_best_precision(P, target_recall).alias("precision_at_recall"))


def grouped_ranking(df: DataFrame, group: str, label: str = "label", score: str = "score", target_recall: float = 0.8,
                    num_blocks: int | None = None) -> DataFrame:
    """One row per group: pos, neg, roc_auc, average_precision, precision_at_recall of its rows.

    All groups' curves in one pass: one row per (group, score), running sums per group over ranges of the score
    whose bounds are quantiles of all scores, so neither a large group nor many groups are one task's work.
    Same values as the metrics of each group by itself.
    """
    per = _per_score(df, label, score, group)
    n = num_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _bucket(per, F.col("__s"), n, descending=True).withColumn("__o", -F.col("__s"))
    known = carried(ranged.where(F.col(group).isNotNull()), [group], "__b", ["__o"],
                    total={"tp": F.col("pos"), "fp": F.col("neg")}, inclusive=True)
    totals = per.groupBy(F.col(group).alias("__g")).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    curve = known.join(totals, F.col(group) == F.col("__g"))
    out = curve.groupBy(group).agg(
        F.max("__P").alias("pos"), F.max("__N").alias("neg"), _misranked().alias("__w"),
        F.sum(F.col("pos").cast("double") * _precision()).alias("__s"),
        _best_precision(F.col("__P"), target_recall).alias("precision_at_recall"))
    return out.select(group, "pos", "neg", _auc(F.col("__w"), F.col("pos"), F.col("neg")).alias("roc_auc"),
                      F.round(F.try_divide(F.col("__s"), F.col("pos").cast("double")), 6).alias("average_precision"),
                      "precision_at_recall")


def confusion(df: DataFrame, threshold, label: str = "label", score: str = "score") -> DataFrame:
    """tp, fp, fn, recall, precision of `score >= threshold` (0.0 on empty denominators)."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= thr
    y = F.col(label) == 1
    c = df.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
               F.count_if(~pred & y).alias("fn"))
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double")),
                                   F.lit(0.0))
    return c.select("tp", "fp", "fn", F.round(rate("tp", "fn"), 6).alias("recall"),
                    F.round(rate("tp", "fp"), 6).alias("precision"))


def fp_reduction(conf: DataFrame, rules_precision: float = 0.05) -> DataFrame:
    """False positives saved against a rules engine assumed to reach the same recall at
    `rules_precision`: rules_fp = tp / rp - tp; reduction = 1 - fp / rules_fp
    (NULL when rules_fp <= 0); alerts per caught fraud = 1 / precision (0 if none)."""
    rp = float(rules_precision)
    tp = F.col("tp").cast("double")
    rules_fp = (tp / F.lit(rp) - tp) if rp else F.lit(float("inf"))
    prec = F.coalesce(F.try_divide(tp, (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    return conf.select(
        "tp", "fp",
        F.round(rules_fp, 4).alias("rules_fp"),
        F.round(F.when(rules_fp > 0, F.lit(1.0) - F.col("fp").cast("double") / rules_fp), 6).alias("fp_reduction"),
        F.round(F.when(prec > 0, F.lit(1.0) / prec).otherwise(F.lit(0.0)), 4).alias("alerts_per_fraud"),
    )


def reliability(df: DataFrame, label: str = "label", prob: str = "prob", n_bins: int = 10) -> DataFrame:
    """Observed rate vs mean prediction per quantile bin (non-empty bins only).

    Edges are the exact 0, 1/n, ..., 1 quantiles of the predictions, deduplicated;
    a prediction's bin is the number of inner edges (all but first and last) <= it.
    """
    qs = [k / n_bins for k in range(n_bins + 1)]
    edges = exact_quantiles(df, prob, qs).select(F.array_distinct(F.col("q")).alias("edges"))
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    p = F.col(prob).cast("double")
    scored = df.filter(F.col(prob).isNotNull()).crossJoin(F.broadcast(edges))  # edges: one row
    b = F.size(F.filter(inner, lambda e: e <= p))
    return scored.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(p), 6).alias("mean_pred"),
        F.round(F.avg(F.col(label).cast("double")), 6).alias("observed_rate"))


def calibration_means(df: DataFrame, label: str = "label", raw: str = "raw_score",
                      calibrated: str = "fraud_probability") -> DataFrame:
    return df.agg(F.round(F.avg(raw), 6).alias("mean_raw"), F.round(F.avg(calibrated), 6).alias("mean_calibrated"),
                  F.round(F.avg(F.col(label).cast("double")), 6).alias("actual_rate"))


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are non-NULL; NULL when either side has no
    spread (the built-in `corr` raises a division error under ANSI mode there)."""
    both = x.isNotNull() & y.isNotNull()
    xp, yp = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))


def feature_direction(df: DataFrame, features, target: str, min_count: int = 10,
                      band: float = 0.05) -> DataFrame:
    """Pearson r of each numeric feature with `target` (guards: more than `min_count`
    non-null values and non-zero spread) and a direction label, in one pass."""
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        pair = F.when(x.isNotNull() & F.col(target).isNotNull(), x)
        aggs += [F.count(pair).alias(f"{f}__n"), F.stddev_pop(pair).alias(f"{f}__sd"),
                 pearson(x, F.col(target).cast("double")).alias(f"{f}__r")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}__n").alias("n"),
                 F.when((F.col(f"{f}__n") > min_count) & (F.col(f"{f}__sd") > 0), F.col(f"{f}__r")).alias("r"))
        for f in features]))
    out = one.select(rows.alias("x")).select("x.*")
    return out.select("feature", "n", F.round("r", 6).alias("r"),
                      F.when(F.col("r") > band, F.lit("up")).when(F.col("r") < -band, F.lit("down"))
                      .when(F.col("r").isNotNull(), F.lit("mixed")).alias("direction"))
