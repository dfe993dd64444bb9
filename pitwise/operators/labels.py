"""Delayed-label assembly with a maturity window.

* `now`       = the latest authorization seen (the snapshot moment),
* `tx_cutoff` = now - maturity_days.

label = 1 when a fraud record exists for the operation AND it was reported by
`now`; label = 0 otherwise (no record, or a record reported after `now`). Rows
authorized after `tx_cutoff` are too young for their truth to be in and are
dropped. Both bounds are scalar subqueries evaluated once by Spark; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.functions.cols import flag
from pitwise.functions.time import days_back

MATURITY_DAYS = 90  # fixed value: default maturity window


def now_ts(tx: DataFrame, ts: str = "authorized_at") -> Column:
    """Scalar subquery: the latest authorization time."""
    return tx.select(F.max(ts)).scalar()


def tx_cutoff(tx: DataFrame, maturity_days: int = MATURITY_DAYS, ts: str = "authorized_at") -> Column:
    # derived from the same scalar subquery as `now_ts`, so Spark evaluates it once
    return days_back(now_ts(tx, ts), maturity_days)


def snapshot_bounds(tx: DataFrame, maturity_days: int = MATURITY_DAYS, ts: str = "authorized_at") -> DataFrame:
    """One row: `now_ts`, `tx_cutoff`."""
    return tx.agg(F.max(ts).alias("now_ts")).select(
        "now_ts", days_back("now_ts", maturity_days).alias("tx_cutoff"))


def maturity_gate(tx: DataFrame, maturity_days: int = MATURITY_DAYS, ts: str = "authorized_at",
                  bounds_from: DataFrame | None = None) -> DataFrame:
    """Keep rows authorized at or before `now - maturity_days` (inclusive).

    `bounds_from` is the table whose latest time defines `now` (default: `tx`).
    """
    src = tx if bounds_from is None else bounds_from
    return tx.filter(F.col(ts) <= tx_cutoff(src, maturity_days, ts))


def immature_tail(tx: DataFrame, maturity_days: int = MATURITY_DAYS, ts: str = "authorized_at") -> DataFrame:
    return tx.filter(F.col(ts) > tx_cutoff(tx, maturity_days, ts))


def attach_labels(tx: DataFrame, labels: DataFrame, now: Column, key: str = "transaction_id",
                  label_col: str = "label", broadcast: bool = False) -> DataFrame:
    """Left-join the (unique-per-operation) fraud records and derive the 0/1 label.

    The unmatched side is tested with `isNotNull` on the right key, never with a
    0 sentinel (ids may be 0). `broadcast=True` only after the caller checked the
    label table's size (see `plans.matrix`).
    """
    lab = labels.select(F.col(key).alias("__lab_key"), F.col("reported_at").alias("__reported_at"))
    if broadcast:
        lab = F.broadcast(lab)
    joined = tx.join(lab, tx[key] == lab["__lab_key"], "left")
    known = F.col("__lab_key").isNotNull() & (F.col("__reported_at") <= now)
    return joined.withColumn(label_col, flag(known)).drop("__lab_key", "__reported_at")


def label_assembly(tx: DataFrame, labels: DataFrame, maturity_days: int = MATURITY_DAYS) -> DataFrame:
    """Qualified (mature) operations with their point-in-time label."""
    return attach_labels(maturity_gate(tx, maturity_days), labels, now_ts(tx))


def carve_report(tx: DataFrame, maturity_days: int = MATURITY_DAYS, ts: str = "authorized_at") -> DataFrame:
    """How the fact is carved by the maturity gate: total = dropped + qualified.

    One pass over the fact with conditional counts, unpivoted to three rows.
    """
    cut = tx_cutoff(tx, maturity_days, ts)
    counts = tx.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(ts) > cut).alias("dropped"),
        F.count_if(F.col(ts) <= cut).alias("qualified"),
    )
    # Bucket captions of the carve report.
    names = {
        "total": "total transactions",
        "dropped": "dropped: immature tail (<90d old)" if maturity_days == 90
        else f"dropped: immature tail (<{maturity_days}d old)",
        "qualified": "qualified for dataset",
    }
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(text).alias("bucket"), F.col(c).alias("n")) for c, text in names.items()
    ])).alias("r")).select("r.bucket", "r.n")


def label_distribution(tx: DataFrame, labels: DataFrame, maturity_days: int = MATURITY_DAYS) -> DataFrame:
    """Label counts among qualified rows with their percentage of the total."""
    from pyspark.sql import Window

    per = label_assembly(tx, labels, maturity_days).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # the unpartitioned window runs over the 2-row aggregate only
    total = F.sum("n").over(Window.partitionBy())
    return per.select("label", "n", F.round(F.lit(100.0) * F.col("n") / total, 3).alias("pct")).orderBy("label")


def never_reported(tx: DataFrame, labels: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Operations with no fraud record at all (the label-0 anti-join)."""
    return tx.join(labels.select(key), key, "left_anti")
