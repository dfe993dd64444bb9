"""Exact-size, reproducible sampling.

Rows are ordered by a seeded hash `md5("<seed>:<id>")`, ties by the row's content, and the first
`n` are kept. A row without an id is hashed by its content, so it has the same chance as any other. This is deterministic, independent of partitioning, and exact in
size -- unlike `DataFrame.sample`, which keeps a random *fraction*.

At scale the top-n is not a driver-side sort or a `limit` (that funnels n rows into one task), and beyond NUMBERED_ROWS
no sort of all rows either: rows are counted by the leading digits of their hash, which tells the digits the n-th row
has. Rows below them are kept by a filter without a shuffle, and only those with the same digits are numbered
(`assign_ids`). Up to NUMBERED_ROWS, and if the number of rows isn't known, candidates under a threshold slightly above the
needed fraction are numbered, or all rows if these are fewer than n (unlucky hash spread). The rows are the same either way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.operators.fingerprint import row_hash
from pitwise.operators.ordering import assign_ids
from pitwise.session import materialize

HEX_DIGITS = 15  # leading md5 hex digits read as a uniform number in [0, 1)
NUMBERED_ROWS = 1_000_000  # tables up to this many rows have their candidates numbered in one go
EDGE_DIGITS = 3  # leading hex digits that rows are counted by: 4,096 counts come to the driver


def seeded_hash(id_col: str, seed: int, without: Column | str = "\\N") -> Column:
    """Hash of the seed and the id; `without` stands for a NULL id."""
    without = F.lit(without) if isinstance(without, str) else without
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), without)))


def _uniform(h: Column) -> Column:
    return F.conv(F.substring(h, 1, HEX_DIGITS), 16, 10).cast("double") / float(16 ** HEX_DIGITS)


def _numbered(pool: DataFrame) -> DataFrame:
    pool = materialize(pool, "sample-pool")  # numbered in three passes
    return assign_ids(pool, ["__h", "__c"], id_col="__rank", bucket_key=_uniform(F.col("__h")))


def hash_top_n(df: DataFrame, n: int, id_col: str, seed: int, margin: float = 0.05,
               total: int | None = None) -> DataFrame:
    """The `n` rows with the smallest seeded hash.

    `total` (row count of `df`) enables the prefilter, and counting by digits for a large table.
    """
    if total is not None and n >= total:
        return df
    if total and total > NUMBERED_ROWS:
        return _top_n_by_digits(df, n, id_col, seed)
    content = row_hash(df)
    pool = h = df.withColumn("__h", seeded_hash(id_col, seed, F.concat(F.lit("\\N:"), content))).withColumn("__c", content)
    if total:
        frac = min(1.0, n / total * (1 + margin) + 1e-3)
        cand = h.filter(_uniform(F.col("__h")) < F.lit(frac))
        if cand.count() >= n:  # candidates are a prefix in hash order: same top-n
            pool = cand
    return _numbered(pool).filter(F.col("__rank") < F.lit(int(n))).drop("__h", "__c", "__rank")


def _top_n_by_digits(df: DataFrame, n: int, id_col: str, seed: int) -> DataFrame:
    content, with_id = row_hash(df), F.col(id_col).isNotNull()
    halves = [(df.filter(with_id), seeded_hash(id_col, seed)),  # the text of a row is made only where its id can't be hashed
              (df.filter(~with_id), seeded_hash(id_col, seed, F.concat(F.lit("\\N:"), content)))]
    digits = lambda h: F.substring(h, 1, EDGE_DIGITS)
    counts = reduce(DataFrame.unionByName, [half.groupBy(digits(h).alias("digits")).count() for half, h in halves])
    below, edge = 0, None
    for edge, rows in sorted(counts.groupBy("digits").agg(F.sum("count")).collect()):
        if below + rows >= n:
            break
        below += rows
    if edge is None:  # no rows
        return df
    pool = reduce(DataFrame.unionByName, [half.withColumn("__h", h).filter(digits(h) == edge) for half, h in halves])
    at_edge = _numbered(pool.withColumn("__c", content)).filter(F.col("__rank") < F.lit(int(n) - below)).drop("__h", "__c", "__rank")
    return reduce(DataFrame.unionByName, [half.filter(digits(h) < edge) for half, h in halves]).unionByName(at_edge)


def undersample(df: DataFrame, label: str = "label", id_col: str = "transaction_id", neg_per_pos: int = 20,
                seed: int = 42) -> DataFrame:
    """Keep every positive and exactly min(n_neg, neg_per_pos * n_pos) negatives."""
    pos = df.filter(F.col(label) == 1)
    neg = df.filter(F.col(label) == 0)
    n_pos, n_neg = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    n_keep = min(n_neg, neg_per_pos * n_pos)
    return pos.unionByName(hash_top_n(neg, n_keep, id_col, seed, total=n_neg))


def undersample_rates(df: DataFrame, sampled: DataFrame, label: str = "label") -> DataFrame:
    """Fraud rate before / after undersampling and the prior shift factor."""
    b = df.agg(F.count(F.lit(1)).alias("rows_before"), F.sum(label).cast("long").alias("pos_before"))
    a = sampled.agg(F.count(F.lit(1)).alias("rows_after"), F.sum(label).cast("long").alias("pos_after"))
    j = b.crossJoin(a)  # 1 x 1 rows
    rb = F.try_divide(F.col("pos_before").cast("double"), F.col("rows_before").cast("double"))
    ra = F.try_divide(F.col("pos_after").cast("double"), F.col("rows_after").cast("double"))
    return j.select("rows_before", "rows_after", "pos_before",
                    F.round(rb, 6).alias("rate_before"), F.round(ra, 6).alias("rate_after"),
                    F.round(F.try_divide(ra, rb), 4).alias("prior_shift"))


def capped_sample(df: DataFrame, cap: int, id_col: str, seed: int = 42) -> DataFrame:
    """All rows when there are at most `cap`, else exactly `cap` hash-chosen rows."""
    total = df.count()
    return hash_top_n(df, min(total, int(cap)), id_col, seed, total=total)
