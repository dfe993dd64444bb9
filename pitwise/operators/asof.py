"""As-of (point-in-time) left join: for each left row, the right row with the same
key and the greatest right time `<=` the left time; right columns are NULL when
there is none (cold start).

Spark has no as-of join in the DataFrame API, so two library forms are provided,
both without theta / nested-loop joins:

* `asof_join` - general right times. Both sides are unioned and one window per key
  carries the last right row forward (`last(..., ignorenulls)` over
  `UNBOUNDED PRECEDING .. CURRENT ROW`, right rows sorted first on equal times).
  One shuffle of both sides. With `bucket_seconds` the window is partitioned by
  `(key, time bucket)` instead, and the value valid at each bucket start is
  carried in from a small per-(key, bucket) timeline, so a hot key is spread over
  many tasks.

* `asof_join_weekly` - right times on a weekly Monday grid (the merchant
  snapshots). Each right row is valid until the key's next snapshot; its validity
  is expanded to the week Mondays it covers and the join becomes an equi-join on
  `(key, monday(left_ts))` with at most one match. The expanded side has at most
  keys x weeks rows; the caller may request a broadcast after checking that bound
  (`broadcast=True`, see `plans.matrix`), otherwise the join is left to AQE: a
  broadcast when the materialized side is small, else a sort-merge join whose
  skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwise.functions.time import monday
from pitwise.session import materialize


HOT_KEYS = 500_000  # a list of hot keys is broadcast up to this many


def _keys(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    bucket_seconds: int | None = None,
    hot_threshold: int | None = None,
    hot_bucket_seconds: int = 86400,
) -> DataFrame:
    """Left rows plus `right_cols` from the latest right row with time <= left time.

    A NULL key matches nothing: such left rows get NULLs, and are kept out of the windows. Times are timestamps, or plain numbers read as seconds. `hot_threshold`: keys
    with more left rows than that take the time-bucketed form (`hot_bucket_seconds`)
    while all other keys keep the one-shuffle form. The list of hot keys is broadcast
    if it is counted to hold at most HOT_KEYS.
    """
    keys = _keys(by)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    if any(left.schema[k].nullable for k in keys):
        unmatched = left.filter(no_key).select(*[F.col(c) for c in left.columns], *[
            F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols])
        matched = _keyed_asof(left.filter(~no_key), right.filter(~no_key), by, left_ts, right_ts, right_cols, bucket_seconds,
                              hot_threshold, hot_bucket_seconds)
        return matched.unionByName(unmatched)
    return _keyed_asof(left, right.filter(~no_key), by, left_ts, right_ts, right_cols, bucket_seconds, hot_threshold,
                       hot_bucket_seconds)


def _keyed_asof(left, right, by, left_ts, right_ts, right_cols, bucket_seconds, hot_threshold, hot_bucket_seconds):
    if hot_threshold is not None and bucket_seconds is None:
        keys = _keys(by)
        hot = materialize(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                          .filter(F.col("__n") > hot_threshold).select(*keys), "hot-keys")
        n_hot = hot.count()
        if n_hot:
            hb = F.broadcast(hot) if n_hot <= HOT_KEYS else hot
            cold = _asof_join(left.join(hb, keys, "left_anti"), right.join(hb, keys, "left_anti"),
                              by, left_ts, right_ts, right_cols, None)
            warm = _asof_join(left.join(hb, keys, "left_semi"), right.join(hb, keys, "left_semi"),
                              by, left_ts, right_ts, right_cols, hot_bucket_seconds)
            return cold.unionByName(warm)
    return _asof_join(left, right, by, left_ts, right_ts, right_cols, bucket_seconds)


def _asof_join(left, right, by, left_ts, right_ts, right_cols, bucket_seconds):
    keys = _keys(by)
    right_cols = list(right_cols)

    def micros(df: DataFrame, c: str):
        # timestamps as unix micros; plain numbers are taken as seconds
        if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.unix_micros(F.col(c).cast("timestamp"))
        return (F.col(c).cast("decimal(38,6)") * F.lit(1_000_000)).cast("long")  # fractions of a second count

    lcols = left.columns
    l = left.select(*[F.col(c) for c in lcols], micros(left, left_ts).alias("__t"), F.lit(1).alias("__side"))
    r = right.select(*[F.col(k) for k in keys], micros(right, right_ts).alias("__t"), F.lit(0).alias("__side"),
                     F.struct(*[F.col(c) for c in right_cols]).alias("__r"))

    if bucket_seconds is None:
        u = l.unionByName(r, allowMissingColumns=True)
        w = Window.partitionBy(*keys).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    else:
        b = int(bucket_seconds) * 1_000_000
        l = l.withColumn("__b", F.floor(F.col("__t") / b))
        r = r.withColumn("__b", F.floor(F.col("__t") / b))
        # latest right row per (key, bucket), then the value valid at each bucket start:
        # a small timeline with one row per (key, bucket) that has left or right rows
        r_last = r.groupBy(*keys, "__b").agg(F.max_by("__r", "__t").alias("__r"))
        timeline = (l.select(*keys, "__b").distinct().withColumn("__r", F.lit(None).cast(r.schema["__r"].dataType))
                    .unionByName(r_last)
                    .groupBy(*keys, "__b").agg(F.first("__r", ignorenulls=True).alias("__r")))
        before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        carry = (timeline.select(*keys, "__b", F.last("__r", ignorenulls=True).over(before).alias("__r"))
                 .filter(F.col("__r").isNotNull())
                 .withColumn("__t", F.lit(None).cast("long")).withColumn("__side", F.lit(-1)))
        u = l.unionByName(r, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
        # carried rows (NULL time) sort first in their bucket
        w = (Window.partitionBy(*keys, "__b").orderBy(F.col("__t").asc_nulls_first(), "__side")
             .rowsBetween(Window.unboundedPreceding, 0))

    out = u.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).filter(F.col("__side") == 1)
    return out.select(*[F.col(c) for c in lcols], *[F.col("__m")[c].alias(c) for c in right_cols])


def asof_join_weekly(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    until=None,
    broadcast: bool = False,
) -> DataFrame:
    """As-of join for right times that are Monday 00:00 (weekly snapshots).

    For a Monday-aligned right time `a`: `a <= t`  <=>  `a <= monday(t)`, so the
    match of `t` is the snapshot valid in week `monday(t)`. `until` (a timestamp
    Column, e.g. a scalar subquery) bounds the expansion from above; it must be at
    or after the latest left time (default: computed from `left`). A right time off
    the grid would match wrongly, so a task that meets one raises.
    """
    keys = _keys(by)
    right_cols = list(right_cols)
    on_grid = F.col(right_ts).isNull() | (F.col(right_ts) == monday(right_ts))
    off = F.raise_error(F.concat(F.lit("not a Monday 00:00: "), F.col(right_ts).cast("string")))
    right = right.withColumn(right_ts, F.when(on_grid, F.col(right_ts)).otherwise(off))
    last_week = monday(until) if until is not None else left.select(F.max(monday(left_ts))).scalar()
    by_key = Window.partitionBy(*keys).orderBy(right_ts)
    start = F.col(right_ts).cast("date")
    nxt = F.lead(F.col(right_ts).cast("date")).over(by_key)
    valid = (right.select(*keys, right_ts, *[c for c in right_cols if c != right_ts])
             .withColumn("__start", start)
             .withColumn("__end", F.least(F.coalesce(F.date_sub(nxt, 7), last_week), last_week))
             .filter(F.col("__start") <= F.col("__end")))
    dense = valid.select(
        *keys,
        F.explode(F.sequence("__start", "__end", F.expr("INTERVAL 7 DAYS"))).alias("__week"),
        *[F.col(c) for c in right_cols],
    )
    renamed = dense.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__week",
                           *[F.col(c).alias(f"__v_{c}") for c in right_cols])
    if broadcast:  # only after the caller checked the size of the expanded side
        renamed = F.broadcast(renamed)
    l = left.withColumn("__week", monday(left_ts))
    cond = [l[k] == renamed[f"__k_{k}"] for k in keys] + [l["__week"] == renamed["__week"]]
    j = l.join(renamed, cond, "left")
    return j.select(*[l[c] for c in left.columns], *[F.col(f"__v_{c}").alias(c) for c in right_cols])
