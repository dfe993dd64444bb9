"""Point-in-time fraud signals of devices, places and declines.

Every value uses the operation itself and earlier ones only.

* `trailing_distinct`     distinct cards seen on a device in a trailing window,
* `device_age`            days since the device was first seen,
* `distance_from_home`    great-circle distance to the customer's home,
* `travel`                distance, time and speed since the customer's last located operation,
* `decline_then_approve`  approvals that end a run of declines.

A device, customer or card may hold a large part of all rows: histories are cut in blocks of time
(`operators.carry`), so none is one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwise.functions.time import epoch_seconds
from pitwise.operators.carry import carried, time_block

EARTH_KM = 6371.0
BLOCK_SECONDS = 30 * 86400


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance of two places in degrees; NULL if a coordinate is.

    The half-angle is taken by atan2, so antipodes (where rounding puts the haversine above 1) are exact.
    """
    a1, o1, a2, o2 = (F.radians((F.col(c) if isinstance(c, str) else c).cast("double")) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    h = F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0))
    km = F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))
    located = a1.isNotNull() & o1.isNotNull() & a2.isNotNull() & o2.isNotNull()  # least() and greatest() skip NULLs
    return F.when(located, km)


def trailing_distinct(df: DataFrame, group: str, value: str, ts: str, window_seconds: int, name: str,
                      block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """`df` plus `name`: distinct non-NULL `value`s among the group's rows of the trailing `window_seconds`.

    The window is closed at both ends and rows of the same second are in it. NULL where group or time is.

    There is no distinct count over a frame, and a set of values a row would grow with the window. Instead a
    visit of a (group, value) pair makes it active for the window's length; visits closer than that are one
    interval, which adds one at its start and takes one away after its end. The count is a running
    sum of these marks. Visits within one window length always merge, so pairs are first reduced to first and
    last visit per such span, before any row is sorted.
    """
    w = int(window_seconds)
    sec = epoch_seconds(ts)
    kept = df.select("*", sec.alias("__sec"), time_block(sec, block_seconds).alias("__b"))
    known = F.col(group).isNotNull() & F.col("__sec").isNotNull()
    spans = (kept.where(known & F.col(value).isNotNull())
             .groupBy(group, value, time_block("__sec", w + 1).alias("__span"))
             .agg(F.min("__sec").alias("first"), F.max("__sec").alias("last")))
    pair = Window.partitionBy(group, value).orderBy("__span")
    edges = spans.select(group, "first", "last", F.lag("last").over(pair).alias("left"), F.lead("first").over(pair).alias("next"))
    mark = lambda at, d: F.struct(at.alias("__sec"), F.lit(d).alias("__d"))
    starts = F.when(F.col("left").isNull() | (F.col("first") - F.col("left") > w), mark(F.col("first"), 1))
    ends = F.when(F.col("next").isNull() | (F.col("next") - F.col("last") > w), mark(F.col("last") + (w + 1), -1))
    marks = (edges.select(group, F.explode(F.array_compact(F.array(starts, ends))).alias("m"))
             .groupBy(group, "m.__sec").agg(F.sum("m.__d").alias("__d")))
    rows = kept.where(known).withColumn("__d", F.lit(0).cast("long")).withColumn("__row", F.lit(1))
    marks = marks.select(group, "__sec", time_block("__sec", block_seconds).alias("__b"), "__d", F.lit(0).alias("__row"))
    summed = carried(rows.unionByName(marks, allowMissingColumns=True), [group], "__b", ["__sec", "__row"],
                     total={name: F.col("__d")}, inclusive=True)
    none = kept.where(~F.coalesce(known, F.lit(False))).withColumn(name, F.lit(None).cast("long"))
    return summed.where("__row = 1").select(*df.columns, name).unionByName(none.select(*df.columns, name))


def device_age(tx: DataFrame, devices: DataFrame, device: str = "device_id", ts: str = "authorized_at") -> DataFrame:
    """`tx` plus `device_age_days`: whole days since the device was first seen; NULL without a device or before that."""
    first = devices.select(F.col(device).alias("__dev"), F.col("first_seen_at").alias("__first"))
    secs = epoch_seconds(ts) - epoch_seconds("__first")
    return tx.join(first, tx[device] == first["__dev"], "left").select(
        *[tx[c] for c in tx.columns], F.when(secs >= 0, F.floor(secs / 86400)).alias("device_age_days"))


def distance_from_home(tx: DataFrame, customers: DataFrame, customer: str = "customer_id", digits: int = 3) -> DataFrame:
    """`tx` plus `home_km`; NULL without a customer row or a coordinate."""
    home = customers.select(F.col(customer).alias("__cust"), "home_lat", "home_lon")
    km = F.round(haversine_km("lat", "lon", "home_lat", "home_lon"), digits)
    return tx.join(home, tx[customer] == home["__cust"], "left").select(*[tx[c] for c in tx.columns], km.alias("home_km"))


def travel(tx: DataFrame, customer: str = "customer_id", ts: str = "authorized_at", order_id: str = "transaction_id",
           max_kmh: float = 900.0, min_km: float = 50.0, digits: int = 3, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """`tx` plus `moved_km`, `moved_secs`, `speed_kmh` since the customer's last located operation, `impossible_travel`.

    Operations without coordinates are passed over, so the one before them is compared. An operation is an
    impossible travel if it is at least `min_km` away and further than `max_kmh` allows; a move in no time
    has no speed but counts. Rows without a customer, time or coordinates get NULL and 0.
    """
    kept = tx.select("*", epoch_seconds(ts).alias("__sec")).withColumn("__b", time_block("__sec", block_seconds))
    known = F.col(customer).isNotNull() & F.col("__sec").isNotNull()
    place = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon", "__sec"))
    seen = carried(kept.where(known), [customer], "__b", ["__sec", order_id], last={"__at": place})
    rest = kept.where(~F.coalesce(known, F.lit(False))).withColumn("__at", F.lit(None).cast(seen.schema["__at"].dataType))
    km = haversine_km("__at.lat", "__at.lon", "lat", "lon")
    secs = F.when(km.isNotNull(), F.col("__sec") - F.col("__at.__sec"))
    far = (km >= float(min_km)) & (km * 3600.0 > F.lit(float(max_kmh)) * secs)
    return seen.unionByName(rest).select(
        *tx.columns, F.round(km, digits).alias("moved_km"), secs.alias("moved_secs"),
        F.round(F.try_divide(km * 3600.0, secs.cast("double")), digits).alias("speed_kmh"),
        F.when(far, 1).otherwise(0).alias("impossible_travel"))


def decline_then_approve(tx: DataFrame, card: str = "card_id", ts: str = "authorized_at", order_id: str = "transaction_id",
                         limit_seconds: int = 3600, min_declines: int = 2, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per approval that ends a run of declines on its card.

    In (second, id) order, a run is `min_declines` or more declines, each at most `limit_seconds` after
    the operation before it, followed by an approval within the same limit. Columns: the card, the
    approval's id, n_declines, first_decline_id, run_secs (first decline to approval). Rows without a card or
    time are in no run.
    """
    declined = F.col("auth_result").eqNullSafe(F.lit("declined"))
    rows = tx.select(card, order_id, epoch_seconds(ts).alias("sec"), declined.cast("int").alias("dec")) \
        .where(F.col(card).isNotNull() & F.col("sec").isNotNull()).withColumn("blk", time_block("sec", block_seconds))
    order = ["sec", order_id]
    linked = carried(rows, [card], "blk", order, last={"prev": F.struct("sec", "dec")}, total={"n_before": F.col("dec")})
    # An operation continues a run if the one before it is a decline, and a recent one.
    goes_on = (F.col("prev.dec") == 1) & (F.col("sec") - F.col("prev.sec") <= int(limit_seconds))
    start = F.when(~F.coalesce(goes_on, F.lit(False)), F.struct("sec", F.col(order_id).alias("id"), "n_before"))
    runs = carried(linked, [card], "blk", order, last={"run": start}, inclusive=True)
    n = F.col("n_before") - F.col("run.n_before")
    return runs.where((F.col("dec") == 0) & (n >= int(min_declines))).select(
        card, order_id, n.alias("n_declines"), F.col("run.id").alias("first_decline_id"),
        (F.col("sec") - F.col("run.sec")).alias("run_secs"))
