"""Keyed queries: device, place and decline signals; streaming velocity state."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise import oracles as O
from pitwise.operators import signals as S
from pitwise.registry import query
from pitwise.session import new_scratch
from pitwise.streaming.scoring import run_to_completion
from pitwise.streaming.velocity import start_velocity_stream

YEAR_HALF = 180 * 86400


def _cards_sql(src: str, group: str, value: str, secs: int) -> str:
    return f"""
SELECT op.transaction_id, op.{group}, CASE WHEN op.{group} IS NOT NULL THEN (
    SELECT count(DISTINCT seen.{value}) FROM {src} seen
    WHERE seen.{group} = op.{group} AND epoch(seen.authorized_at) <= epoch(op.authorized_at)
      AND epoch(seen.authorized_at) >= epoch(op.authorized_at) - {secs}) END AS n_cards
FROM {src} op"""


@query("device_cards", O.sql(_cards_sql("transactions", "device_id", "card_id", YEAR_HALF)))
def q_device_cards(t):
    """Distinct cards per device over the trailing 180 days."""
    return S.trailing_distinct(t.transactions.select("transaction_id", "device_id", "card_id", "authorized_at"), "device_id",
                               "card_id", "authorized_at", YEAR_HALF, "n_cards").select("transaction_id", "device_id", "n_cards")


@query("device_cards_events", O.sql(_cards_sql("event_transactions", "customer_id", "merchant_id", 86400),
                                    views=["event_transactions"]))
def q_device_cards_events(t):
    """Dense variant: distinct merchants per user over a day, histories cut every five days."""
    rows = t.event_transactions.select("transaction_id", "customer_id", "merchant_id", "authorized_at")
    return S.trailing_distinct(rows, "customer_id", "merchant_id", "authorized_at", 86400, "n_cards",
                               block_seconds=5 * 86400).select("transaction_id", "customer_id", "n_cards")


@query("device_age", O.sql("""
SELECT transaction_id, (epoch(authorized_at) - (SELECT epoch(first_seen_at) FROM devices WHERE devices.device_id = op.device_id))
  ::BIGINT // 86400 AS device_age_days FROM transactions op"""))
def q_device_age(t):
    return S.device_age(t.transactions, t.devices).select("transaction_id", "device_age_days")


# Chord length through the sphere, an independent form of the great-circle distance.
def _km(a: str, b: str, c: str, d: str) -> str:
    lat1, lon1, lat2, lon2 = (f"radians({x}::DOUBLE)" for x in (a, b, c, d))
    x, y, z = (f"(cos({lat1}) * cos({lon1}) - cos({lat2}) * cos({lon2}))", f"(cos({lat1}) * sin({lon1}) - cos({lat2}) * sin({lon2}))",
               f"(sin({lat1}) - sin({lat2}))")
    chord = f"sqrt({x} ** 2 + {y} ** 2 + {z} ** 2)"
    return f"CASE WHEN {a} + {b} + {c} + {d} IS NOT NULL THEN 2 * 6371.0 * asin(least(1.0, {chord} / 2)) END"


@query("distance_from_home", O.sql(f"""
SELECT transaction_id, round({_km('lat', 'lon', 'home_lat', 'home_lon')}, 3) AS home_km
FROM located_transactions LEFT JOIN customers USING (customer_id)""", views=["located_transactions", "customers"]))
def q_distance_from_home(t):
    return S.distance_from_home(t.located_transactions, t.customers).select("transaction_id", "home_km")


@query("impossible_travel", O.sql(f"""
SELECT op.transaction_id, round(km, 3) AS moved_km, secs AS moved_secs, round(km * 3600.0 / nullif(secs, 0), 3) AS speed_kmh,
  coalesce((km >= 50.0 AND km * 3600.0 > 900.0 * secs)::INTEGER, 0) AS impossible_travel
FROM located_transactions op LEFT JOIN LATERAL (
  SELECT {_km('old.lat', 'old.lon', 'op.lat', 'op.lon')} AS km,
    CASE WHEN op.lat IS NOT NULL AND op.lon IS NOT NULL THEN (epoch(op.authorized_at) - epoch(old.authorized_at))::BIGINT END AS secs
  FROM located_transactions old
  WHERE old.customer_id = op.customer_id AND old.lat IS NOT NULL AND old.lon IS NOT NULL
    AND (old.authorized_at, old.transaction_id) < (op.authorized_at, op.transaction_id)
  ORDER BY old.authorized_at DESC, old.transaction_id DESC LIMIT 1) ON true""", views=["located_transactions"]))
def q_impossible_travel(t):
    return S.travel(t.located_transactions).select("transaction_id", "moved_km", "moved_secs", "speed_kmh", "impossible_travel")


@query("decline_then_approve", O.sql("""
SELECT customer_id, op.transaction_id, count(*) AS n_declines,
  arg_min(old.transaction_id, old.place) AS first_decline_id, any_value(op.sec) - min(old.sec) AS run_secs
FROM placed op JOIN placed old USING (customer_id)
WHERE op.auth_result = 'approved' AND old.place < op.place AND NOT EXISTS (  -- nothing breaks the run in between
  SELECT 1 FROM placed x JOIN placed y ON y.customer_id = x.customer_id AND y.place = x.place + 1
  WHERE x.customer_id = op.customer_id AND x.place >= old.place AND x.place < op.place
    AND (x.auth_result <> 'declined' OR y.sec - x.sec > 21600))
GROUP BY customer_id, op.transaction_id HAVING count(*) >= 2""", """
placed AS (SELECT *, epoch(authorized_at)::BIGINT AS sec,
  row_number() OVER (PARTITION BY customer_id ORDER BY authorized_at, transaction_id) AS place FROM event_transactions)""",
    views=["event_transactions"]))
def q_decline_then_approve(t):
    """Two or more declines, each within six hours of the next operation, then an approval."""
    return S.decline_then_approve(t.event_transactions, card="customer_id", limit_seconds=21600, block_seconds=2 * 86400)


# ---------------------------------------------------------------- streaming state


@query("velocity_stream", O.sql("SELECT transaction_id, customer_id, vel_1h, vel_24h, vel_7d FROM feat",
                                O.window_cte(src="event_transactions"), views=["event_transactions"]))
def q_velocity_stream(t):
    """Velocity by state: the events arrive in five loads, up to half an hour out of order, and a heartbeat ends them.

    The query is stopped and started again after each load, so its state comes from the checkpoint.
    """
    src = t.event_transactions.select("transaction_id", "customer_id", "authorized_at")
    base = new_scratch(t.spark, "velocity-stream")
    arrival = F.unix_timestamp(F.col("authorized_at").cast("timestamp")) + F.pmod(F.xxhash64("transaction_id"), F.lit(1800))
    load = F.floor((F.dayofmonth(F.timestamp_seconds(arrival)) - 1) / 7)
    beat = src.agg((F.max("authorized_at") + F.expr("INTERVAL 30 DAYS")).alias("authorized_at")).select(
        F.lit(None).cast("long").alias("transaction_id"), F.lit(None).cast("long").alias("customer_id"), "authorized_at")
    for part in [*[src.where(load == i) for i in range(5)], beat]:
        part.write.mode("append").parquet(f"{base}/in")
        ops = t.spark.readStream.schema(src.schema).parquet(f"{base}/in")
        run_to_completion([start_velocity_stream(ops, f"{base}/out", f"{base}/checkpoint", lateness="31 minutes")])
    return t.spark.read.parquet(f"{base}/out")
