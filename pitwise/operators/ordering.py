"""Global order operators without a single-partition window.

A window with an ORDER BY and no PARTITION BY moves every row into one task.
These operators number rows / accumulate sums in a global order in two passes:

1. bucket bounds: approximate quantiles of the (numeric) leading order key, one
   aggregate pass; the `num_buckets - 1` bounds come back to the driver as a
   short list of literals, so every later recomputation (e.g. after a lost
   executor) buckets rows identically,
2. bucket totals: an aggregate over at most `num_buckets` groups, turned into
   bucket offsets by a running sum over that tiny table and broadcast (its size is
   bounded by `num_buckets`),
3. inside each bucket a window partitioned by the bucket does the local numbering /
   running sum; offset + local value is the global result.

Buckets are contiguous ranges of the leading key, so (bucket, order) is the
global order. The full order must be unique (add tie-break columns) for the
numbering to be deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _num_buckets(df: DataFrame, num_buckets: int | None) -> int:
    if num_buckets:
        return int(num_buckets)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _numeric_key(df: DataFrame, c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(c, str):
        t = df.schema[c].dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(col.cast("timestamp")).cast("double")
        if isinstance(t, T.DateType):
            return F.unix_date(col).cast("double")
    return col.cast("double")


def _nulls_last(order: Column | str) -> bool:
    """Whether the leading order column puts NULL last (Spark's default when descending)."""
    text = str(order)
    if "NULLS FIRST" in text or "NULLS LAST" in text:
        return "NULLS LAST" in text
    return "DESC" in text


def _bucket(df: DataFrame, key: Column, n: int, descending: bool = False, nulls_last: bool = False) -> DataFrame:
    """`df` plus `__b`, a bucket id that follows the order of `key`.

    Rows with a NULL key have a bucket of their own, before or after all others. The bounds are placed with a binary search (`Bucketizer`, JVM side), so the
    per-row cost is O(log n) however many buckets the cluster uses.
    """
    from pyspark.ml.feature import Bucketizer

    keyed = df.withColumn("__k", key.cast("double"))
    if n <= 1:
        return keyed.withColumn("__b", F.lit(0)).drop("__k")
    qs = [i / n for i in range(1, n)]
    row = keyed.agg(F.percentile_approx("__k", qs, 10_000).alias("b")).first()
    bounds = sorted({float(b) for b in (row["b"] or []) if b is not None})
    if not bounds:
        return keyed.withColumn("__b", F.lit(0)).drop("__k")
    # bucket = number of bounds <= key (ascending) / number of bounds > key (descending)
    splits = [float("-inf"), *bounds, float("inf")]
    b = Bucketizer(splits=splits, inputCol="__k", outputCol="__bk", handleInvalid="keep").transform(keyed)
    idx = F.col("__bk").cast("int")  # NaN, the greatest number, is kept in a bucket after the last
    idx = (F.lit(len(bounds)) - idx) if descending else idx
    null_bucket = F.lit(len(bounds) + 2 if nulls_last else -2)
    return b.withColumn("__b", F.when(F.col("__k").isNull(), null_bucket).otherwise(idx)).drop("__k", "__bk")


def _offsets(df: DataFrame, bucket: str, totals: dict[str, Column]) -> DataFrame:
    per = df.groupBy(bucket).agg(*[v.alias(f"__t_{k}") for k, v in totals.items()])
    w = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # <= num_buckets rows
    return per.select(bucket, *[F.coalesce(F.sum(f"__t_{k}").over(w), F.lit(0)).cast("long").alias(f"__o_{k}")
                                for k in totals])


def assign_ids(df: DataFrame, order: Sequence[Column | str], id_col: str = "row_id",
               num_buckets: int | None = None, bucket_key: Column | None = None, start: int = 0) -> DataFrame:
    """Consecutive ids `start, start+1, ...` in ascending `order` (surrogate keys after a sort).

    `bucket_key`: numeric expression non-decreasing along `order` (default: the first
    order column as a number).
    """
    n = _num_buckets(df, num_buckets)
    key = bucket_key if bucket_key is not None else _numeric_key(df, order[0])
    b = _bucket(df, key, n, nulls_last=_nulls_last(order[0]))
    offs = _offsets(b, "__b", {"n": F.count(F.lit(1))})
    local = F.row_number().over(Window.partitionBy("__b").orderBy(*order)) - 1
    out = b.withColumn("__local", local).join(F.broadcast(offs), "__b")
    return out.withColumn(id_col, F.col("__o_n") + F.col("__local") + F.lit(start)).drop("__b", "__local", "__o_n")


def running_sums(df: DataFrame, order: Sequence[Column | str], value_cols: Sequence[str],
                 num_buckets: int | None = None, bucket_key: Column | None = None, descending: bool = False,
                 suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums (long) of `value_cols` along `order`.

    `descending` must match the direction of `order` on its leading key.
    """
    n = _num_buckets(df, num_buckets)
    value_cols = list(value_cols)
    key = bucket_key if bucket_key is not None else _numeric_key(df, order[0])
    b = _bucket(df, key, n, descending, _nulls_last(order[0]))
    offs = _offsets(b, "__b", {c: F.sum(c) for c in value_cols})
    w = Window.partitionBy("__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = b.select("*", *[F.sum(c).over(w).cast("long").alias(f"__l_{c}") for c in value_cols])
    out = local.join(F.broadcast(offs), "__b")
    return out.select(*[F.col(c) for c in df.columns],
                      *[(F.col(f"__o_{c}") + F.col(f"__l_{c}")).alias(f"{c}{suffix}") for c in value_cols])
