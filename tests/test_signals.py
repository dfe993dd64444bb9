from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitwise.operators import signals as S

T0 = datetime(2024, 1, 1)
SCHEMA = "transaction_id long, k long, v long, authorized_at timestamp_ntz, lat double, lon double, auth_result string, secret int"


def history(n: int, seed: int, keys=(1, 1, 1, 1, 2, 3, None)):
    """A hot key, NULLs everywhere, many equal times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if rng.random() < 0.03 else T0 + timedelta(seconds=rng.choice([0, 60, 3600]) * rng.randrange(200))
        lat = None if rng.random() < 0.2 else rng.choice([55.7, -55.7, 0.0, 90.0, 40.0])
        rows.append((i, rng.choice(keys), rng.choice([1, 2, 3, 4, 5, None]), at, lat, rng.choice([37.6, -142.4, 0.0, 180.0, None]),
                     rng.choice(["declined", "declined", "approved", None]), 7))
    return rows


def sec(row):
    return int((row[3] - T0).total_seconds())


@pytest.mark.parametrize("window, block", [(3600, 86400), (86400, 7200), (0, 3600), (10 ** 7, 3600)])
def test_trailing_distinct_equals_brute_force(spark, window, block):
    rows = history(300, window % 97)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.transaction_id: r.n for r in S.trailing_distinct(df, "k", "v", "authorized_at", window, "n", block).collect()}
    want = {r[0]: None if r[1] is None or r[3] is None else len(
        {o[2] for o in rows if o[1] == r[1] and o[3] is not None and o[2] is not None and 0 <= sec(r) - sec(o) <= window})
        for r in rows}
    assert got == want


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    cos = math.sin(lat1) * math.sin(lat2) + math.cos(lat1) * math.cos(lat2) * math.cos(lon1 - lon2)
    return S.EARTH_KM * math.acos(max(-1.0, min(1.0, cos)))


def test_haversine_antipodes_poles_and_nulls(spark):
    pairs = [((55.7, 37.6), (-55.7, -142.4)), ((0.0, 0.0), (0.0, 180.0)), ((90.0, 0.0), (90.0, 99.0)), ((90.0, 0.0), (-90.0, 0.0)),
             ((40.0, 179.9), (40.0, -179.9)), ((12.5, 12.5), (12.5, 12.5))]
    df = spark.createDataFrame([(i, *a, *b) for i, (a, b) in enumerate(pairs)], "i int, a double, b double, c double, d double")
    got = {r.i: r.km for r in df.select("i", S.haversine_km("a", "b", "c", "d").alias("km")).collect()}
    assert all(got[i] == pytest.approx(km(*p), abs=1e-3) for i, p in enumerate(pairs))
    assert got[0] == pytest.approx(math.pi * S.EARTH_KM, abs=1e-6)
    for c in "abcd":
        null = df.withColumn(c, F.lit(None).cast("double")).select(S.haversine_km("a", "b", "c", "d")).distinct().collect()
        assert null == [(None,)]


def test_travel_passes_over_operations_without_a_place(spark):
    rows = history(300, 5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.transaction_id: r for r in S.travel(df, customer="k", block_seconds=7200).collect()}
    located = [r for r in rows if r[1] is not None and r[3] is not None and r[4] is not None and r[5] is not None]
    assert len(got) == len(rows) and set(got[0].asDict()) == {*SCHEMA.replace(",", "").split()[::2], "moved_km", "moved_secs",
                                                            "speed_kmh", "impossible_travel"}
    for r in rows:
        old = [o for o in located if o[1] == r[1] and r[3] is not None and (sec(o), o[0]) < (sec(r), r[0])]
        out = got[r[0]]
        if r not in located or not old:
            assert (out.moved_km, out.moved_secs, out.speed_kmh, out.impossible_travel) == (None, None, None, 0)
            continue
        o = max(old, key=lambda x: (sec(x), x[0]))
        d, s = km(o[4:6], r[4:6]), sec(r) - sec(o)
        assert out.moved_km == pytest.approx(d, abs=2e-3) and out.moved_secs == s
        assert out.speed_kmh == (pytest.approx(d * 3600 / s, abs=0.1) if s else None)
        assert out.impossible_travel == int(d >= 50 and d * 3600 > 900 * s)


@pytest.mark.parametrize("block", [3600, 10 ** 7])
def test_decline_runs_equal_brute_force(spark, block):
    rows = history(400, 11)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in S.decline_then_approve(df, card="k", limit_seconds=7200, block_seconds=block).collect())
    want = []
    for k in {r[1] for r in rows} - {None}:
        mine = sorted(((sec(r), r[0], r[6]) for r in rows if r[1] == k and r[3] is not None), key=lambda x: x[:2])
        run = []
        for s, i, result in mine:
            if run and s - run[-1][0] > 7200:
                run = []
            if result == "declined":
                run.append((s, i))
            else:
                if len(run) >= 2:
                    want.append((k, i, len(run), run[0][1], s - run[0][0]))
                run = []
    assert got == sorted(want) and want


def test_device_age_and_home(spark):
    tx = spark.createDataFrame([(1, 7, T0 + timedelta(days=2, hours=23)), (2, 7, T0 - timedelta(seconds=1)), (3, None, T0), (4, 7, None),
                                (5, 8, T0)], "transaction_id long, device_id long, authorized_at timestamp_ntz")
    devices = spark.createDataFrame([(7, T0), (None, T0)], "device_id long, first_seen_at timestamp_ntz")
    assert {r.transaction_id: r.device_age_days for r in S.device_age(tx, devices).collect()} == {1: 2, 2: None, 3: None, 4: None, 5: None}
    ops = spark.createDataFrame([(1, 9, 0.0, 0.0), (2, 9, None, 0.0), (3, 10, 1.0, 1.0), (4, None, 1.0, 1.0)],
                                "transaction_id long, customer_id long, lat double, lon double")
    homes = spark.createDataFrame([(9, 0.0, 90.0), (10, None, 1.0)], "customer_id long, home_lat double, home_lon double")
    got = {r.transaction_id: r.home_km for r in S.distance_from_home(ops, homes).collect()}
    assert got == {1: pytest.approx(math.pi / 2 * S.EARTH_KM, abs=1e-3), 2: None, 3: None, 4: None}


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.trailing_distinct(df, "k", "v", "authorized_at", 60, "n").count() == 0
    assert S.travel(df, customer="k").count() == 0 and S.decline_then_approve(df, card="k").count() == 0


def test_a_hot_device_is_split_by_time(spark):
    """Every window is partitioned by (key, block), or runs over the table of blocks."""
    df = spark.createDataFrame(history(10, 1), SCHEMA)
    plan = S.trailing_distinct(df, "k", "v", "authorized_at", 60, "n")._jdf.queryExecution().optimizedPlan().toString()
    rows_windows = [line for line in plan.splitlines() if "Window" in line and "__row" in line]
    assert rows_windows and all("[k#" in line and "__b#" in line for line in rows_windows)
