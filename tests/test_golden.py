"""Hand-computed mini tables: frame edges, first rows, label timing, as-of edges."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pitwise.operators import labels as L
from pitwise.operators.asof import asof_join, asof_join_weekly
from pitwise.operators.windows import customer_window_features

T0 = datetime(2024, 3, 4, 12, 0, 0)  # a Monday noon
TX_SCHEMA = "transaction_id long, customer_id long, authorized_at timestamp_ntz, amount decimal(14,2), auth_result string"


def tx(spark, data):
    return spark.createDataFrame(data, TX_SCHEMA)


def test_velocity_frame_edges_and_peers(spark):
    d = [
        (1, 7, T0, Decimal("10.00"), "approved"),
        (2, 7, T0 + timedelta(seconds=3600), Decimal("10.00"), "approved"),   # exactly 1h later: inside
        (3, 7, T0 + timedelta(seconds=7201), Decimal("10.00"), "approved"),   # 3601 s after #2: outside
        (4, 7, T0 + timedelta(seconds=7201), Decimal("10.00"), "declined"),   # same-second peer of #3
    ]
    out = {r[0]: r[1:] for r in rows(customer_window_features(tx(spark, d)),
                                     "transaction_id", "vel_1h", "vel_24h", "secs_since_prev")}
    assert out[1] == (0, 0, None)
    assert out[2] == (1, 1, 3600)
    # RANGE frame: a same-second peer with a later id is counted, only self is subtracted
    assert out[3] == (1, 3, 3601)
    assert out[4] == (1, 3, 0)


def test_prior20_stats_exclude_current_and_stop_at_20(spark):
    d = [(i, 1, T0 + timedelta(minutes=i), Decimal(str(100 + (i % 3))), "declined" if i == 1 else "approved")
         for i in range(1, 24)]
    out = {r[0]: r[1:] for r in rows(customer_window_features(tx(spark, d)),
                                     "transaction_id", "amount_z", "decline_rate_20")}
    assert out[1] == (None, None)            # no history
    assert out[2] == (None, 1.0)             # one prior op: stddev 0 -> NULL z; it was declined
    assert out[21][1] == 0.05                # 20 prior ops, one declined
    assert out[22][1] == 0.0                 # row 22 no longer sees row 1


def test_maturity_gate_and_label_timing(spark):
    now = T0 + timedelta(days=200)
    d = [
        (1, 1, now - timedelta(days=90), Decimal("1.00"), "approved"),                       # exactly at cutoff: kept
        (2, 1, now - timedelta(days=90) + timedelta(seconds=1), Decimal("1.00"), "approved"),  # 1 s later: dropped
        (3, 2, T0, Decimal("1.00"), "approved"),
        (4, 3, T0, Decimal("1.00"), "approved"),
        (5, 4, now, Decimal("1.00"), "approved"),                                            # defines now
    ]
    labels = spark.createDataFrame(
        [(10, 3, now), (11, 4, now + timedelta(seconds=1))],
        "label_id long, transaction_id long, reported_at timestamp_ntz")
    t = tx(spark, d)
    got = dict(rows(L.label_assembly(t, labels), "transaction_id", "label"))
    assert got == {1: 0, 3: 1, 4: 0}  # reported at now -> 1; one second after now -> 0
    carve = dict(rows(L.carve_report(t), "bucket", "n"))
    assert carve["total transactions"] == 5
    assert carve["total transactions"] == carve["qualified for dataset"] + carve["dropped: immature tail (<90d old)"]


@pytest.mark.parametrize("form", ["plain", "bucketed", "weekly", "hot_split"])
def test_asof_cold_start_exact_and_stale(spark, form):
    monday = datetime(2024, 3, 4)
    right = spark.createDataFrame(
        [(1, monday, 0.1), (1, monday + timedelta(weeks=1), 0.2), (2, monday, 0.5)],
        "merchant_id long, as_of_date timestamp_ntz, rate double")
    left = spark.createDataFrame(
        [(100, 1, monday - timedelta(seconds=1)),            # before any snapshot -> NULL
         (101, 1, monday),                                   # exactly at a snapshot -> that one
         (102, 1, monday + timedelta(days=8)),               # second snapshot
         (103, 2, monday + timedelta(weeks=30)),             # idle merchant: stale snapshot
         (104, 3, monday + timedelta(days=1))],              # unknown merchant -> NULL
        "transaction_id long, merchant_id long, authorized_at timestamp_ntz")
    args = (left, right, "merchant_id", "authorized_at", "as_of_date", ["rate"])
    if form == "plain":
        j = asof_join(*args)
    elif form == "bucketed":
        j = asof_join(*args, bucket_seconds=86400)
    elif form == "hot_split":
        j = asof_join(*args, hot_threshold=1, hot_bucket_seconds=86400)  # merchant 1 hot, others not
    else:
        j = asof_join_weekly(*args)
    got = dict(rows(j, "transaction_id", "rate"))
    assert got == {100: None, 101: 0.1, 102: 0.2, 103: 0.5, 104: None}


def test_weekly_stats_fast_equals_direct(spark, tables):
    from pitwise.operators.weekly import merchant_weekly_stats

    a = merchant_weekly_stats(tables.transactions, tables.fraud_labels)
    # every operation is given to the 13 Mondays after its week; a report counts from the Monday after it
    report = tables.fraud_labels.select("transaction_id", "reported_at")
    later = F.explode(F.expr("transform(sequence(1, 13), i -> cast(date_trunc('week', authorized_at) + make_dt_interval(7 * i) AS timestamp_ntz))"))
    each = tables.transactions.join(report, "transaction_id", "left").select("merchant_id", "reported_at", later.alias("as_of_date"))
    b = each.groupBy("merchant_id", "as_of_date").agg(
        F.count("*").alias("n_tx"), F.count_if(F.col("reported_at") < F.col("as_of_date")).alias("n_fraud_known")).withColumn(
        "fraud_rate_pit", (F.col("n_fraud_known") + 2.0) / (F.col("n_tx") + 500.0))
    cols = ["merchant_id", "as_of_date", "n_tx", "n_fraud_known", "fraud_rate_pit"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_quality_checks_find_violations(spark):
    from pitwise.operators import quality as Q

    parent = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "cid long, pid long")
    u = Q.unique_summary(parent, "p", ["id"]).first()
    assert (u["n_rows"], u["n_keys"], u["n_duplicate_keys"], u["n_surplus_rows"]) == (3, 2, 1, 1)
    fk = Q.foreign_key_summary(child, "c", "pid", parent, "p", "id").first()
    assert fk["n_orphans"] == 1  # 9 is an orphan; NULL references are allowed
    nn = dict(rows(Q.null_counts(child, "c", ["cid", "pid"]), "column_name", "n_null"))
    assert nn == {"cid": 0, "pid": 1}
    d = Q.apply_defaults(spark.createDataFrame([(None, None), ("USD", True)], "currency string, f boolean"),
                         {"currency": "RUB", "f": False})
    assert rows(d) == [("RUB", False), ("USD", True)]


def test_weekly_rows_are_added_up_where_they_are_multiplied(tables):
    """The expansion by weeks is not exchanged: 13 times the merchants' weeks would cross the network."""
    from pitwise.operators.weekly import merchant_weekly_stats

    plan = merchant_weekly_stats(tables.transactions, tables.fraud_labels)._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "Generate" in plan and "Exchange" not in plan[:plan.index("Generate")]
