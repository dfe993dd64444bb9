"""Temporal train / validation / test split and its checks.

train: ts <= train_end;  val: train_end < ts <= val_end;  test: ts > val_end.
The cut points are the 0.70 / 0.85 quantiles of the authorization time, fixed in
the snapshot manifest so every consumer splits identically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.operators.quantiles import exact_quantiles, quantiles_as_timestamps

# Default split fractions (cumulative time quantiles).
TRAIN_Q = 0.70
VAL_Q = 0.85


def cut_points(df: DataFrame, ts: str = "authorized_at", train_q: float = TRAIN_Q, val_q: float = VAL_Q,
               approx: bool = False) -> DataFrame:
    """One row: `train_end`, `val_end`."""
    q = exact_quantiles(df, ts, [train_q, val_q], kind="timestamp", approx=approx)
    return quantiles_as_timestamps(q, ["train_end", "val_end"])


def split_column(ts: Column | str, train_end, val_end) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.when(t <= train_end, F.lit("train"))
            .when(t <= val_end, F.lit("val"))
            .otherwise(F.lit("test")))


def temporal_split(df: DataFrame, cuts: DataFrame | None = None, ts: str = "authorized_at",
                   split_col: str = "split") -> DataFrame:
    """Tag every row with its split; cut points from `cuts` (default: computed on `df`)."""
    cuts = cut_points(df, ts) if cuts is None else cuts
    row = cuts.first()  # two timestamps; they become literals of the split expression
    if row is None or row["train_end"] is None or row["val_end"] is None:  # no rows to split
        return df.withColumn(split_col, F.lit(None).cast("string"))
    # a snapshot manifest holds the cut points as text
    te, ve = (F.lit(x if isinstance(x := row[c], str) else x.isoformat(sep=" ")).cast("timestamp_ntz")
              for c in ("train_end", "val_end"))
    return df.withColumn(split_col, split_column(ts, te, ve))


def split_summary(split_df: DataFrame, ts: str = "authorized_at", label: str = "label",
                  split_col: str = "split") -> DataFrame:
    return split_df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).cast("long").alias("positives"),
        F.round(F.coalesce(F.try_divide(F.sum(label).cast("double"), F.count(F.lit(1)).cast("double")),
                           F.lit(0.0)), 6).alias("fraud_rate"),
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
    )


def split_check(split_df: DataFrame, ts: str = "authorized_at", split_col: str = "split") -> DataFrame:
    """One row: the splits are disjoint in time (train <= val <= test)."""
    s = split_df.groupBy().agg(*[
        F.max(F.when(F.col(split_col) == p, F.col(ts))).alias(f"{p}_max") for p in ("train", "val")
    ], *[F.min(F.when(F.col(split_col) == p, F.col(ts))).alias(f"{p}_min") for p in ("val", "test")])
    ok1 = F.coalesce(F.col("train_max") <= F.col("val_min"), F.lit(True))
    ok2 = F.coalesce(F.col("val_max") <= F.col("test_min"), F.lit(True))
    return s.select("train_max", "val_min", "val_max", "test_min",
                    ok1.alias("train_before_val"), ok2.alias("val_before_test"), (ok1 & ok2).alias("ok"))


def assert_disjoint(split_df: DataFrame, **kw) -> None:
    """Raise when the splits overlap in time (one scalar comes back to the driver)."""
    row = split_check(split_df, **kw).first()
    if not row["ok"]:
        raise AssertionError(f"temporal splits overlap: {row.asDict()}")
