"""Constraint checks as Spark jobs (the operational store's PK / UNIQUE / FK /
NOT NULL / DEFAULT rules). Every check is an aggregate or an anti-join; each
returns a small report DataFrame and never collects the checked table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.sources.schemas import TABLES, TableSpec


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def unique_summary(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys occurring more than once, surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("n_surplus_rows"),
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent (NULL references are allowed)."""
    p = parent.select(F.col(pk).alias("__pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("__pk"), "left_anti")


def foreign_key_summary(child: DataFrame, child_name: str, fk: str, parent: DataFrame, parent_name: str,
                        pk: str) -> DataFrame:
    """Orphan rows and orphan key values of one reference.

    The child is first reduced to (key, rows) with map-side partial aggregation, so a
    key holding a large share of the child never lands in one join task; only the
    distinct keys are anti-joined with the parent.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("__rows"))
    o = orphans(keys, fk, parent, pk)
    return o.agg(
        F.lit(child_name).alias("child_table"), F.lit(fk).alias("fk_column"),
        F.lit(parent_name).alias("parent_table"), F.lit(pk).alias("pk_column"),
        F.coalesce(F.sum("__rows"), F.lit(0)).cast("long").alias("n_orphans"),
        F.count(F.lit(1)).alias("n_orphan_keys"),
    )


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL count of every listed column in one pass, as (table, column, n_null) rows."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
        for c in columns
    ])).alias("r")).select("r.*")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs of defaulted columns with their declared default."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c) if c in defaults else F.col(c)
        for c in df.columns
    ])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def check_unique(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    frames = []
    for name, spec in specs.items():
        if name in tables:
            frames.append(unique_summary(tables[name], name, spec.primary_key))
            for u in spec.unique:
                frames.append(unique_summary(tables[name], name, u))
    return _union(frames)


def check_foreign_keys(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    frames = []
    for name, spec in specs.items():
        for col, parent, pk in spec.references:
            if name in tables and parent in tables:
                frames.append(foreign_key_summary(tables[name], name, col, tables[parent], parent, pk))
    return _union(frames)


def check_not_null(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    return _union([null_counts(tables[n], n, s.not_null) for n, s in specs.items() if n in tables])
