"""Inspection reports: one customer's feature timeline, one merchant's weekly rate
evolution and its as-of listing. They exist to eyeball the point-in-time
invariants (no row sees itself; the as-of date precedes the operation).

Ties in the reference's "top 1" picks are arbitrary; here they are broken by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.functions.cols import flag
from pitwise.operators.asof import asof_join_weekly
from pitwise.operators.windows import customer_window_features
from pitwise.plans.matrix import HOT_CUSTOMER_ROWS

LISTING_ROWS = 20  # fixed value: length of the demo listings


def fraud_count_by_customer(tx: DataFrame, labels: DataFrame) -> DataFrame:
    return (labels.select("transaction_id")
            .join(tx.select("transaction_id", "customer_id"), "transaction_id", "inner")
            .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_fraud")))


def top_fraud_customer(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """The customer with the most fraud records (ties -> smallest id)."""
    return fraud_count_by_customer(tx, labels).orderBy(F.desc("n_fraud"), "customer_id").limit(1)


def customer_timeline(tx: DataFrame, labels: DataFrame, customer_id=None) -> DataFrame:
    """Window features of one customer (default: the top fraud customer).

    The customer filter is on the window partition key, so Catalyst pushes it
    below the window and down to the scan.
    """
    if customer_id is None:
        customer_id = top_fraud_customer(tx, labels).select("customer_id").scalar()
    one = tx.filter(F.col("customer_id") == customer_id).select(
        "transaction_id", "customer_id", "authorized_at", "amount", "country", "auth_result")
    # a very large customer is windowed by the split path; the demo rounds coarser, once
    feats = customer_window_features(one, digits=2, rate_digits=3, hot_threshold=HOT_CUSTOMER_ROWS)
    lab = labels.select(F.col("transaction_id").alias("__lk"))
    j = feats.join(lab, feats["transaction_id"] == lab["__lk"], "left")
    return j.select(
        "authorized_at", "amount", "country", F.col("auth_result").alias("result"),
        "vel_1h", "vel_24h", "vel_7d", "secs_since_prev",
        "amount_z", "decline_rate_20", flag(F.col("__lk").isNotNull()).alias("is_fraud"), "transaction_id",
    ).orderBy("authorized_at", "transaction_id").drop("transaction_id")


def top_fraud_merchant(weekly: DataFrame):
    """Scalar subquery: merchant of the snapshot with the most known fraud."""
    return weekly.orderBy(F.desc("n_fraud_known"), "merchant_id").limit(1).select("merchant_id").scalar()


def merchant_rate_evolution(weekly: DataFrame, merchant_id=None, rows: int = LISTING_ROWS) -> DataFrame:
    mid = top_fraud_merchant(weekly) if merchant_id is None else merchant_id
    return (weekly.filter(F.col("merchant_id") == mid)
            .select("merchant_id", "as_of_date", "n_tx", "n_fraud_known",
                    F.round("fraud_rate_pit", 5).alias("rate"))
            .orderBy("as_of_date").limit(rows))


def merchant_asof_listing(tx: DataFrame, weekly: DataFrame, merchant_id=None, rows: int = LISTING_ROWS) -> DataFrame:
    mid = top_fraud_merchant(weekly) if merchant_id is None else merchant_id
    t = tx.filter(F.col("merchant_id") == mid).select("transaction_id", "authorized_at", "merchant_id")
    j = asof_join_weekly(t, weekly.withColumn("rate_as_of", F.col("as_of_date")), "merchant_id",
                         "authorized_at", "as_of_date", ["rate_as_of", "fraud_rate_pit"])
    return (j.select("transaction_id", "authorized_at", "merchant_id", "rate_as_of",
                     F.round("fraud_rate_pit", 5).alias("merchant_fraud_rate_pit"))
            .orderBy("authorized_at", "transaction_id").limit(rows))
