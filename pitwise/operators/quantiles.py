"""Exact linear-interpolated quantiles, computed distributed.

For q in [0, 1] over n non-null values sorted ascending (v_0 .. v_{n-1}):
pos = q * (n - 1), result = v_lo + (pos - lo) * (v_hi - v_lo) with lo = floor(pos),
hi = ceil(pos) -- the usual "linear" definition.

Spark's exact `percentile` aggregate merges a value->count map of every distinct
value in one final task; here the values are numbered in global order with the
two-pass range-partition scheme as (value, count) rows with running sums, so equal
values are one row, and only the rows that hold the needed positions are kept. No
task ever holds more than its range of distinct values. `approx=True` switches to `percentile_approx` (one pass, bounded error).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.operators.ordering import running_sums
from pitwise.session import materialize


def _as_double(c: Column, kind: str) -> Column:
    return F.unix_micros(c.cast("timestamp")).cast("double") if kind == "timestamp" else c.cast("double")


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float], kind: str = "double",
                    approx: bool = False, accuracy: int = 100_000) -> DataFrame:
    """One row, one array column `q` with the quantiles (as double; micros for timestamps)."""
    v = _as_double(F.col(column), kind)
    vals = df.select(v.alias("__v")).filter(F.col("__v").isNotNull())
    if approx:
        return vals.agg(F.percentile_approx("__v", list(qs), accuracy).cast("array<double>").alias("q"))
    # the input is read once; the total, bounds, offsets and sums are taken from the written counts
    per = materialize(vals.groupBy("__v").agg(F.count(F.lit(1)).alias("__n")), "value-counts")
    n = per.agg(F.sum("__n")).first()[0] or 0  # one scalar; the positions become literals
    if n == 0:
        return vals.sparkSession.range(1).select(F.array(*[F.lit(None).cast("double") for _ in qs]).alias("q"))
    upto = running_sums(per, ["__v"], ["__n"])
    pos = [F.lit(float(q) * (n - 1)) for q in qs]
    wanted = sorted({math.floor(float(q) * (n - 1)) for q in qs} | {math.ceil(float(q) * (n - 1)) for q in qs})
    # a value covers the positions [sum before it, sum up to it)
    covered = F.filter(F.array(*[F.lit(w) for w in wanted]),
                       lambda i: (i >= F.col("__n_cum") - F.col("__n")) & (i < F.col("__n_cum")))
    picked = upto.select(F.explode(covered).alias("__i"), "__v")
    # <= 2 * len(qs) rows: gather them into one small map
    m = picked.agg(F.map_from_entries(F.collect_list(F.struct(F.col("__i").cast("long"), F.col("__v")))).alias("m"))
    out = []
    for p in pos:
        lo, hi = F.floor(p), F.ceil(p)
        vlo, vhi = F.col("m")[lo], F.col("m")[hi]
        out.append(vlo + (p - lo) * (vhi - vlo))
    return m.select(F.array(*out).alias("q"))


def quantiles_as_timestamps(qdf: DataFrame, names: Sequence[str]) -> DataFrame:
    """Micros -> TIMESTAMP_NTZ columns named `names` (truncating below 1 us)."""
    return qdf.select(*[
        F.timestamp_micros(F.col("q")[i].cast("long")).cast("timestamp_ntz").alias(n) for i, n in enumerate(names)])
