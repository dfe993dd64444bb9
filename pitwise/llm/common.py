"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwise.session import materialize

__all__ = ["WORD", "arrow_map", "bounded", "ints", "key_column", "materialize", "n_words", "numbered", "unit_hash"]

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

# Broadcasts are taken only below this many bytes, proven before the plan is made.
BROADCAST_BYTES = 32 << 20


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_column(name: str) -> Column:
    """The column of that exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def unit_hash(col: Column, seed: str) -> Column:
    """A reproducible number in [0, 1) from the text of `col` and a seed (52 bits of an MD5)."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(col.cast("string"), F.lit("\\N")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def bounded(df: DataFrame, rows: int, row_bytes: int) -> bool:
    """Whether `df` is proven to hold at most `rows` rows and BROADCAST_BYTES bytes (reads rows + 1 at most)."""
    if rows * row_bytes > BROADCAST_BYTES:
        rows = BROADCAST_BYTES // row_bytes
    return df.limit(rows + 1).count() <= rows


def arrow_map(df: DataFrame, fn: Callable[..., dict], schema: str, *args) -> DataFrame:
    """Apply `fn(batch, *args) -> {column: array or list}` to every Arrow batch of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = fn(batch, *args)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in cols.values()], names=list(cols))

    return df.mapInArrow(run, schema)


def ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An Arrow integer column without nulls as numpy."""
    return batch.column(name).to_numpy(zero_copy_only=False)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """`df` with `position`, 0 to n - 1 in ascending order of the columns `order` (nulls first).

    A range exchange sorts, the row index within each sorted partition is written with the rows, and
    the offsets of the partitions (one row each) are broadcast. No task sees more than its range.
    """
    index = F.monotonically_increasing_id()  # partition << 33 | row of the partition
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("position", index), name)
    size = rows.groupBy(F.shiftright("position", 33).alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.withColumn("part", F.shiftright("position", 33))
            .join(F.broadcast(size.select("part", before.alias("before"))), "part")
            .withColumn("position", F.col("before") + F.col("position").bitwiseAND((1 << 33) - 1)).drop("part", "before"))
