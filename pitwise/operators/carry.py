"""Values carried along a key's history, with no key larger than one task.

A window per key puts all rows of a key in one task. Here a key's history is cut in blocks (of time), each
block is one window partition, and what a block needs from earlier ones comes from a table with one row per
(key, block): its last values and its sums, carried over blocks by a window of that small table. The table is
joined on the columns the windows are partitioned by, so the rows are shuffled once.

Rows whose key or block is NULL are no part of a history: callers keep them aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_block(seconds: Column | str, block_seconds: int) -> Column:
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.floor(col / F.lit(int(block_seconds)))


def carried(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], last: dict[str, Column] | None = None,
            total: dict[str, Column] | None = None, inclusive: bool = False) -> DataFrame:
    """`df` plus, over the earlier rows of the key (and the row itself if `inclusive`),

    * for each entry of `last` the latest non-NULL value of that expression (NULL if there is none),
    * for each entry of `total` the sum of that expression (0 if there is none).

    `block` must not decrease along `order`; `order` must be unique within a key for a defined result.
    """
    last, total = last or {}, total or {}
    put = df.select("*", *[e.alias(f"__{n}") for n, e in {**last, **total}.items()])
    place = F.struct(*order)
    per = put.groupBy(*keys, block).agg(
        *[F.max_by(f"__{n}", F.when(F.col(f"__{n}").isNotNull(), place)).alias(f"__in_{n}") for n in last],
        *[F.sum(f"__{n}").alias(f"__in_{n}") for n in total])
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(*keys, block,
                        *[F.last(f"__in_{n}", ignorenulls=True).over(earlier).alias(f"__in_{n}") for n in last],
                        *[F.coalesce(F.sum(f"__in_{n}").over(earlier), F.lit(0)).alias(f"__in_{n}") for n in total])
    here = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return put.join(before, [*keys, block]).select(
        *[F.col(c) for c in df.columns],
        *[F.coalesce(F.last(f"__{n}", ignorenulls=True).over(here), F.col(f"__in_{n}")).alias(n) for n in last],
        *[(F.coalesce(F.sum(f"__{n}").over(here), F.lit(0)) + F.col(f"__in_{n}")).alias(n) for n in total])
