"""Order-free content fingerprint of a DataFrame.

Spark writes a result as many part files whose bytes depend on partitioning, and
a query without ORDER BY has no row order, so hashing file bytes is not stable.
Instead every row is rendered as canonical text (columns in name order, each value
with its length before it, NULL as `-`), hashed with md5, the hash is cut into four
32-bit words, and the words are summed over all rows as DECIMAL(38,0) (plus the
row count). Sums commute, so the result does
not depend on partitioning or row order; the final sha256 of the sums is the
fingerprint. One aggregate pass with map-side partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXT = "-"  # a value is `<characters>:<text>`, so no text equals it


def double_text(c: Column) -> Column:
    """Every bit of a double, in the same text on any engine: sign, mantissa as an integer, p, binary exponent.

    Decimal text depends on an engine's rules, and a fixed number of digits gives different numbers one text.
    Scaling by powers of two is exact. 0 and -0 are one text.
    """
    c = c.cast("double")
    a = F.abs(c)
    # log2 may be off by one next to a power of two
    e = F.floor(F.log2(a)).cast("int")
    m = a / F.pow(F.lit(2.0), e)
    e = e + F.when(m >= 2, 1).when(m < 1, -1).otherwise(0)
    whole = (a / F.pow(F.lit(2.0), e) * float(1 << 52)).cast("long")
    text = F.concat(F.when(c < 0, "-").otherwise(""), whole.cast("string"), F.lit("p"), e.cast("string"))
    return (F.when(c.isNull(), F.lit(None).cast("string")).when(F.isnan(c), "nan").when(a == float("inf"), F.when(c > 0, "inf")
            .otherwise("-inf")).when(a == 0, "0").otherwise(text))


def canonical_text(field: T.StructField) -> Column:
    c = F.col(field.name)
    t = field.dataType
    if isinstance(t, (T.DoubleType, T.FloatType)):
        txt = double_text(c)
    elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        txt = F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(t, T.DateType):
        txt = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(t, T.BooleanType):
        txt = F.when(c, F.lit("true")).otherwise(F.lit("false"))
    else:
        txt = c.cast("string")
    return F.coalesce(F.concat(F.length(txt).cast("string"), F.lit(":"), txt), F.lit(NULL_TEXT))


def row_hash(df: DataFrame) -> Column:
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return F.md5(F.concat_ws("|", *[canonical_text(f) for f in fields]))


def fingerprint_parts(df: DataFrame) -> DataFrame:
    """One row: n_rows and the four word sums."""
    h = df.select(row_hash(df).alias("__h"))
    word = lambda i: F.conv(F.substring("__h", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")
    return h.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.coalesce(F.sum(word(i)), F.lit(0)).cast("decimal(38,0)").alias(f"s{i}") for i in range(4)])


def content_fingerprint(df: DataFrame) -> DataFrame:
    """One row: `n_rows`, `sha256` (order- and partition-independent)."""
    p = fingerprint_parts(df)
    return p.select("n_rows", F.sha2(F.concat_ws(":", *[F.col(c).cast("string")
                                                         for c in ("n_rows", "s0", "s1", "s2", "s3")]), 256)
                    .alias("sha256"))
