"""Strictly backward per-customer velocity and deviation features.

For every operation only rows at or before it in the customer's history feed its
features, and the row itself is excluded:

* `vel_1h / vel_24h / vel_7d` - operations of the customer in the trailing 3600 /
  86400 / 604800 seconds (RANGE frame on unix seconds, so same-second peers are
  counted; only the row itself is subtracted),
* `secs_since_prev` - seconds since the previous operation (NULL for the first),
* `amount_z` - z-score of the amount against the 20 previous operations
  (population stddev; NULL when there is no history or the stddev is 0),
* `decline_rate_20` - share of declined among the 20 previous operations.

Plan shape: all window columns share the partitioning `customer_id` and the sort
prefix `(epoch, transaction_id)`, so Spark plans one Exchange and one Sort for all
of them (checked in tests/test_plans.py). The ROWS frames are bounded (20 rows) and
the RANGE frames are incremental, so a long history costs a single streaming pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwise.functions.time import epoch_seconds
from pitwise.operators.asof import asof_join
from pitwise.session import materialize

# Frame sizes of the reference feature set.
VELOCITY_WINDOWS = {"vel_1h": 3600, "vel_24h": 86400, "vel_7d": 604800}
PRIOR_ROWS = 20
Z_DIGITS = 4
HOT_KEYS = 500_000  # a list of hot customers is broadcast up to this many


def customer_window_features(
    tx: DataFrame,
    key: str = "customer_id",
    ts: str = "authorized_at",
    order_id: str = "transaction_id",
    amount: str = "amount",
    auth_result: str = "auth_result",
    velocity: dict[str, int] | None = None,
    prior_rows: int = PRIOR_ROWS,
    digits: int = Z_DIGITS,
    rate_digits: int | None = None,
    hot_threshold: int | None = None,
    bucket_seconds: int = 86400,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Append the window features to `tx` (all input columns are kept).

    With `hot_threshold`, customers holding more than that many rows (operations
    without a customer count as one) are computed by `hot_customer_features` (split
    by time buckets and row blocks, never one task per customer); all others by the
    single-window plan. Both give the same rows, also with repeated or NULL ids and
    times. The list of hot keys is broadcast if it is counted to hold at most HOT_KEYS.
    `rate_digits` rounds the decline rate (default: as `digits`).
    """
    args = dict(key=key, ts=ts, order_id=order_id, amount=amount, auth_result=auth_result,
                velocity=velocity, prior_rows=prior_rows, digits=digits,
                rate_digits=digits if rate_digits is None else rate_digits)
    if hot_threshold is None:
        return _single_window(tx, **args)
    hot = tx.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_threshold).select(F.col(key).alias("__hot"))
    hot = materialize(hot, "hot-keys")  # a narrow list, counted once for all that follows
    n_hot = hot.count()
    if not n_hot:  # the usual case: keep the one-shuffle plan
        return _single_window(tx, **args)
    if n_hot <= HOT_KEYS:
        hot = F.broadcast(hot)
    is_hot = F.col(key).eqNullSafe(F.col("__hot"))
    cold_rows = tx.join(hot, is_hot, "left_anti")
    hot_rows = tx.join(hot, is_hot, "left_semi")
    return _single_window(cold_rows, **args).unionByName(
        hot_customer_features(hot_rows, bucket_seconds=bucket_seconds, block_rows=block_rows, **args))


def _parts(df, ts, amount, auth_result):
    amt = F.col(amount).cast("double")
    declined = F.when(F.col(auth_result) == "declined", F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumn("__epoch", epoch_seconds(ts)), amt, declined


def _single_window(tx, key, ts, order_id, amount, auth_result, velocity, prior_rows, digits, rate_digits):
    velocity = VELOCITY_WINDOWS if velocity is None else velocity
    ep = "__epoch"
    df, amt, declined = _parts(tx, ts, amount, auth_result)

    by_key = Window.partitionBy(key)
    w_rows = by_key.orderBy(F.col(ep), F.col(order_id))
    w_prior = w_rows.rowsBetween(-prior_rows, -1)
    w_range = {name: by_key.orderBy(F.col(ep)).rangeBetween(-secs, 0) for name, secs in velocity.items()}

    prior_mean = F.avg(amt).over(w_prior)
    prior_std = F.stddev_pop(amt).over(w_prior)

    # ROWS-frame columns first, then RANGE-frame columns: both orders start with the
    # same epoch column, so one sort on (key, epoch, id) serves every window.
    cols = [
        (F.col(ep) - F.lag(ep, 1).over(w_rows)).alias("secs_since_prev"),
        F.round((amt - prior_mean) / F.nullif(prior_std, F.lit(0.0)), digits).alias("amount_z"),
        F.round(F.avg(declined).over(w_prior), rate_digits).alias("decline_rate_20"),
    ]
    cols += [(F.count(F.lit(1)).over(w) - 1).alias(name) for name, w in w_range.items()]
    return df.select("*", *cols).drop(ep)


def hot_customer_features(tx, key="customer_id", ts="authorized_at", order_id="transaction_id", amount="amount",
                          auth_result="auth_result", velocity=None, prior_rows=PRIOR_ROWS, digits=Z_DIGITS,
                          rate_digits=Z_DIGITS, bucket_seconds: int = 86400, block_rows: int = 1_000_000) -> DataFrame:
    """Same features for customers too large for one task, with bounded tasks.

    1. position `idx` of every row in its customer's (epoch, id) order: per
       (customer, day bucket) counts -> offsets over the small bucket table, plus a
       row number inside each (customer, bucket);
    2. ROWS frames (previous row, previous 20 rows): blocks of `block_rows`
       consecutive positions, each block also given the last `prior_rows` rows of
       the block before it, one window per (customer, block);
    3. RANGE counts: rows in [t - W, t] = #(epoch <= t) - #(epoch < t - W). The first
       term is the largest position among the row's same-second peers + 1; the
       second is an as-of lookup of the probe time t - W - 1 s into the customer's
       own (epoch -> largest position) table, split by time bucket.

    Rows are told apart by (customer, position), which is unique whatever their ids.
    Rows without a time come first in their customer's order and count each other only,
    as in the single window.
    """
    velocity = VELOCITY_WINDOWS if velocity is None else velocity
    ep = "__epoch"
    df, amt, declined = _parts(tx, ts, amount, auth_result)
    df = df.withColumn("__b", F.floor(F.col(ep) / F.lit(int(bucket_seconds))))

    # 1. global position inside the customer
    per_bucket = df.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__nb"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    timeless = F.sum(F.when(F.col("__b").isNull(), F.col("__nb"))).over(Window.partitionBy(key))
    offs = per_bucket.select(key, "__b", F.coalesce(F.sum("__nb").over(before), F.lit(0)).alias("__off"),
                             F.coalesce(timeless, F.lit(0)).alias("__timeless"))
    w_local = Window.partitionBy(key, "__b").orderBy(F.col(ep), F.col(order_id))
    w_peers = Window.partitionBy(key, "__b").orderBy(F.col(ep)).rangeBetween(0, 0)
    local = df.withColumn("__loc", F.row_number().over(w_local) - 1)
    offs = offs.select(F.col(key).alias("__ok"), F.col("__b").alias("__ob"), "__off", "__timeless")
    same = F.col(key).eqNullSafe(F.col("__ok")) & F.col("__b").eqNullSafe(F.col("__ob"))
    pos = local.join(offs, same).withColumn("__idx", F.col("__off") + F.col("__loc")).drop("__ok", "__ob", "__off")
    pos = pos.withColumn("__le", F.max("__idx").over(w_peers) + 1)  # rows with epoch <= t
    # read three times below (row blocks, lookup table, probes): number the rows once
    pos = materialize(pos, "hot-positions")

    # 2. ROWS frames over position blocks; a row is also copied, as halo, into every
    #    later block whose first row is at most `prior_rows` positions after it
    R = max(1, int(block_rows))
    blk = F.floor(F.col("__idx") / F.lit(R))
    last_blk = F.floor((F.col("__idx") + F.lit(prior_rows)) / F.lit(R))
    own = pos.withColumn("__blk", blk).withColumn("__halo", F.lit(False))
    halo = (pos.filter(last_blk > blk)
            .withColumn("__blk", F.explode(F.sequence(blk + 1, last_blk))).withColumn("__halo", F.lit(True)))
    w_rows = Window.partitionBy(key, "__blk").orderBy("__idx")
    w_prior = w_rows.rowsBetween(-prior_rows, -1)
    rows_feats = own.unionByName(halo).select(
        *tx.columns, "__idx", "__halo",
        (F.col(ep) - F.lag(ep, 1).over(w_rows)).alias("secs_since_prev"),
        F.round((amt - F.avg(amt).over(w_prior)) / F.nullif(F.stddev_pop(amt).over(w_prior), F.lit(0.0)),
                digits).alias("amount_z"),
        F.round(F.avg(declined).over(w_prior), rate_digits).alias("decline_rate_20"),
    ).filter(~F.col("__halo")).drop("__halo")

    # 3. RANGE counts through an as-of lookup of each probe time
    # (the key is wrapped, so that rows without a customer, which are one history here, find each other)
    lookup = (pos.filter(F.col(ep).isNotNull()).groupBy(F.struct(key).alias("__key"), F.col(ep).alias("__pt"))
              .agg(F.max("__idx").alias("__lastidx")))
    probes = None
    for name, secs in velocity.items():
        p = pos.select(F.struct(key).alias("__key"), "__idx", F.lit(name).alias("__w"), (F.col(ep) - F.lit(secs + 1)).alias("__pt"),
                       "__le", "__timeless")
        probes = p if probes is None else probes.unionByName(p)
    hit = asof_join(probes, lookup, "__key", "__pt", "__pt", ["__lastidx"], bucket_seconds=bucket_seconds)
    older = F.when(F.col("__pt").isNull(), F.lit(0)).otherwise(F.coalesce(F.col("__lastidx") + 1, F.col("__timeless")))
    counts = hit.select(F.col("__key")[key].alias("__rk"), F.col("__idx").alias("__ri"), "__w",
                        (F.col("__le") - older - 1).alias("__cnt"))
    range_feats = counts.groupBy("__rk", "__ri").pivot("__w", list(velocity)).agg(F.first("__cnt"))

    same_row = F.col(key).eqNullSafe(F.col("__rk")) & (F.col("__idx") == F.col("__ri"))
    return rows_feats.join(range_feats, same_row).drop("__idx", "__rk", "__ri")


WINDOW_FEATURES = ["vel_1h", "vel_24h", "vel_7d", "secs_since_prev", "amount_z", "decline_rate_20"]
