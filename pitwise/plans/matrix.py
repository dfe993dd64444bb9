"""The flat, leak-free training matrix: one row per qualified operation.

Blocks (each an operator of its own):
  windows   strictly backward velocity / deviation features per customer,
  labels    0/1 label known at `now`, maturity gate `authorized_at <= now - 90d`,
  merchant  static merchant attributes (mcc, risk tier),
  weekly    point-in-time merchant fraud rate via an as-of join to weekly snapshots.

The maturity gate is applied *before* the windows: it keeps a prefix in time and
every frame looks backward, so the surviving rows get identical features while the
windows sort fewer rows (Catalyst cannot push a filter on a non-partition column
below a window by itself). The weekly snapshots still see every operation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.functions.cols import flag
from pitwise.operators import labels as L
from pitwise.operators.asof import asof_join_weekly
from pitwise.operators.weekly import merchant_weekly_stats
from pitwise.operators.windows import customer_window_features
from pitwise.session import materialize

ID_COLUMNS = ["transaction_id", "customer_id", "authorized_at"]
LABEL_COLUMN = "label"
# The feature contract (order matters) and its categorical subset.
FEATURES = [
    "amount", "hour", "channel", "entry_mode", "is_ecommerce", "is_recurring", "is_tokenized",
    "country", "ip_mismatch", "vel_1h", "vel_24h", "vel_7d", "secs_since_prev", "amount_z",
    "decline_rate_20", "mcc", "risk_segment", "merchant_fraud_rate_pit",
]
CAT_FEATURES = ["channel", "entry_mode", "country", "mcc", "risk_segment"]
MATRIX_COLUMNS = ID_COLUMNS + FEATURES + [LABEL_COLUMN]
# What the matrix reads of an operation.
OPERATION_COLUMNS = [
    "transaction_id", "customer_id", "authorized_at", "merchant_id", "amount", "channel",
    "entry_mode", "is_ecommerce", "is_recurring", "is_tokenized", "country", "ip_country",
    "auth_result"]


def ip_mismatch(ip_country="ip_country", country="country"):
    ip, c = F.col(ip_country), F.col(country)
    return flag(ip.isNotNull() & (ip != c))


def attach_merchant_static(tx: DataFrame, merchants: DataFrame) -> DataFrame:
    m = merchants.select(F.col("merchant_id").alias("__mid"), "mcc", "risk_segment")
    return tx.join(m, tx["merchant_id"] == m["__mid"], "left").drop("__mid")


HOT_CUSTOMER_ROWS = 2_000_000  # customers above this are windowed by the split path
# Join sides with at most this many (narrow) rows are broadcast; larger ones are shuffled.
BROADCAST_MAX_ROWS = 4_000_000


def operations(tx: DataFrame) -> DataFrame:
    """The columns of `tx` that the matrix reads, written once: the weekly table, the gate, the count of hot
    customers and the windows each read them, and the operations may be a join of the largest tables."""
    return materialize(tx.select(*OPERATION_COLUMNS), "operations")


def dense_weekly_bound(weekly: DataFrame) -> int:
    """Proven upper bound of the rows of the week-expanded snapshot side of the as-of
    join: merchants x weeks between the first and the last snapshot (the expansion
    never runs past the last data week, which precedes the last snapshot)."""
    row = weekly.agg(F.count_distinct("merchant_id").alias("m"), F.min("as_of_date").alias("lo"),
                     F.max("as_of_date").alias("hi")).first()
    if row["m"] == 0 or row["lo"] is None:
        return 0
    return int(row["m"]) * ((row["hi"] - row["lo"]).days // 7 + 1)


def feature_matrix(
    tx: DataFrame,
    labels: DataFrame,
    merchants: DataFrame,
    maturity_days: int = L.MATURITY_DAYS,
    weekly: DataFrame | None = None,
    hot_threshold: int | None = HOT_CUSTOMER_ROWS,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """The 22-column matrix (3 ids, 18 features, label).

    `hot_threshold`: customers with more operations are windowed by the split path
    (`operators.windows.hot_customer_features`); None disables the check.
    """
    if weekly is None:
        # the rebuilt derived table: written once to the shared folder, then sized
        weekly = materialize(merchant_weekly_stats(tx, labels), "merchant-weekly")
    # Size checks before planning: a side is broadcast only when its row count is
    # bounded (AQE alone would decide after the fact side had already been shuffled).
    small_labels = labels.count() <= broadcast_max_rows
    small_weekly = dense_weekly_bound(weekly) <= broadcast_max_rows
    now = L.now_ts(tx)
    gated = L.maturity_gate(tx.select(*OPERATION_COLUMNS), maturity_days, bounds_from=tx)
    feats = customer_window_features(gated, hot_threshold=hot_threshold)
    labelled = L.attach_labels(feats, labels, now, broadcast=small_labels)
    with_m = attach_merchant_static(labelled, merchants)
    with_rate = asof_join_weekly(with_m, weekly, "merchant_id", "authorized_at", "as_of_date",
                                 ["fraud_rate_pit"], until=now, broadcast=small_weekly)
    return with_rate.select(
        "transaction_id", "customer_id", "authorized_at", "amount",
        F.hour("authorized_at").alias("hour"),
        "channel", "entry_mode",
        F.col("is_ecommerce").cast("int").alias("is_ecommerce"),
        F.col("is_recurring").cast("int").alias("is_recurring"),
        F.col("is_tokenized").cast("int").alias("is_tokenized"),
        "country",
        ip_mismatch().alias("ip_mismatch"),
        "vel_1h", "vel_24h", "vel_7d", "secs_since_prev", "amount_z", "decline_rate_20",
        "mcc", "risk_segment",
        F.col("fraud_rate_pit").alias("merchant_fraud_rate_pit"),
        "label",
    )
