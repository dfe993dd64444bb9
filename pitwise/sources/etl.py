"""Loading and copying the operational tables.

* `conform` - select by name in the declared order and cast to the declared types
  (never by position); timestamps are truncated to whole seconds (the analytical
  copy keeps second precision, so `(ts, id)` and `(epoch, id)` orders agree).
* `reload_table` - idempotent truncate-and-reload of one table into Parquet.
* `save_bucketed` - the analytical copy as a catalog table, bucketed and sorted by its key, so that
  windows and joins on the key need no shuffle.
* `read_generations` - files written before and after additive migrations, read as one typed table.
* `read_jdbc` / `read_jdbc_even` / `write_jdbc` - partitioned parallel JDBC read, by a number range or by
  quantiles that the source is asked for; truncating write.
* `write_csv` / `read_csv` - bulk text export: no header, NULL as `\\N`,
  booleans as `true/false`.
* `publish_load` / `latest_load` - all-or-nothing multi-table load: tables are
  written parents-first under a fresh load id, and only a final commit marker makes
  the load visible; a failed load leaves no marker and readers keep the previous one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwise.sources.schemas import LOAD_ORDER, TABLES, TableSpec

NULL_TOKEN = "\\N"  # fixed value: NULL marker of the bulk text format


def conform(df: DataFrame, spec: TableSpec, allow_missing: bool = False) -> DataFrame:
    """Project `df` onto the declared schema by column name."""
    cols = []
    for f in spec.schema.fields:
        if f.name not in df.columns:
            if not (allow_missing and f.nullable):
                raise ValueError(f"{spec.name}: missing column {f.name}")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_trunc("second", c.cast("timestamp")).cast(f.dataType)
        else:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def reload_table(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Truncate-and-reload: overwrite the table's folder with the conformed rows.

    Rows are ranged by the declared sort key over the files and sorted within them, so
    Parquet min/max statistics let a filter on the key skip files.
    """
    out = conform(df, spec)
    if spec.sort_key:
        out = out.repartitionByRange(*spec.sort_key).sortWithinPartitions(*spec.sort_key)
    out.write.mode("overwrite").parquet(path)


def save_bucketed(df: DataFrame, spec: TableSpec, table: str, path: str, buckets: int = 200) -> DataFrame:
    """The conformed rows as table `table` at `path`, bucketed by the first sort key, sorted by all; returns the table.

    Rows are dealt by the bucketing hash before they are written, so a bucket is one file. Windows
    and joins partitioned by the key read the buckets as they are: no Exchange (plan test).
    """
    key, *_ = spec.sort_key
    rows = conform(df, spec).repartition(buckets, key).sortWithinPartitions(*spec.sort_key)
    (rows.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(*spec.sort_key)
     .format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def read_generations(spark: SparkSession, paths: str | list[str], spec: TableSpec) -> DataFrame:
    """Parquet files of several schema generations as the declared table, columns found by name.

    The footers are merged and checked first: a column that older files lack must be nullable, a type must
    be the declared one or widen to it without loss, and a column that isn't declared is refused. Then files
    are read by the declared schema, so a column that a file lacks is NULL and only wanted columns are read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    declared = {f.name: f for f in spec.schema.fields}
    problems = [f"{f.name} is not declared" for f in found if f.name not in declared]
    for name, want in declared.items():
        if name not in found.names:
            problems += [] if want.nullable else [f"{name} is missing"]
        elif not _widens(found[name].dataType, want.dataType):
            problems.append(f"{name} is {found[name].dataType.simpleString()}, declared {want.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{spec.name}: " + "; ".join(problems))
    # read by the types found (a widened file column can't be read as the wider type), then conform
    as_found = T.StructType([T.StructField(f.name, found[f.name].dataType if f.name in found.names else f.dataType, True)
                             for f in spec.schema.fields])
    return conform(spark.read.schema(as_found).parquet(*paths), spec)


_WIDER = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def _widens(found: T.DataType, want: T.DataType) -> bool:
    if isinstance(found, T.DecimalType) and isinstance(want, T.DecimalType):
        return found.scale <= want.scale and found.precision - found.scale <= want.precision - want.scale
    a, b = found.simpleString(), want.simpleString()
    return a == b or (a in _WIDER and _WIDER[a] <= _WIDER.get(b, 0)) or (a, b) == ("float", "double")


def _literal(value) -> str:
    """A value of the source as an SQL literal (times in JDBC's own notation, which drivers translate)."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, datetime):
        return "{ts '" + value.isoformat(sep=" ") + "'}"
    if isinstance(value, date):
        return "{d '" + value.isoformat() + "'}"
    return "'" + str(value).replace("'", "''") + "'"


def quantile_predicates(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                        properties: Mapping[str, str] | None = None) -> list[str]:
    """Conditions that cut the table into parts of about equal row counts, whatever the type and skew of the key.

    The source is asked for the key's quantiles (one indexed row each); equal ones are one bound. NULL keys are
    a part of their own, and every row meets exactly one condition.
    """
    def ask(query: str):
        return spark.read.format("jdbc").options(url=url, query=query, **dict(properties or {})).load().first()

    n = int(ask(f"SELECT COUNT({column}) AS N FROM {table}")[0])
    cuts = []
    for i in range(1, num_partitions):
        if n * i // num_partitions:
            row = ask(f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL ORDER BY {column} "
                      f"OFFSET {n * i // num_partitions} ROWS FETCH NEXT 1 ROWS ONLY")
            if not cuts or row[0] != cuts[-1]:
                cuts.append(row[0])
    bounds = [_literal(c) for c in cuts]
    parts = [" AND ".join([f"{column} >= {lo}"] * (lo is not None) + [f"{column} < {hi}"] * (hi is not None)) or f"{column} IS NOT NULL"
             for lo, hi in zip([None, *bounds], [*bounds, None])]
    return [f"{column} IS NULL", *parts]


def read_jdbc_even(spark: SparkSession, url: str, table: str, column: str, num_partitions: int = 8,
                   properties: Mapping[str, str] | None = None) -> DataFrame:
    """Full-table JDBC scan in parts of about equal size, by quantiles of any ordered column."""
    conditions = quantile_predicates(spark, url, table, column, num_partitions, properties)
    return spark.read.jdbc(url, table, predicates=conditions, properties=dict(properties or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 8,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """Full-table JDBC scan; with a numeric partition column the read is split into
    `num_partitions` range queries run by the executors in parallel."""
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               truncate: bool = True) -> None:
    """Idempotent reload of a JDBC table (TRUNCATE keeps the target's DDL)."""
    (df.write.mode("overwrite").option("truncate", "true" if truncate else "false")
     .jdbc(url, table, properties=dict(properties or {})))


# Line ends and the escape sign itself are written as backslash sequences, so every record
# is one line (the files stay splittable) and no text equals the NULL marker.
_MARK = "\u0001"  # stands for a backslash while the other sequences are read; written as a sequence itself
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), (_MARK, "\\1"))
_CSV_OPTIONS = {"header": "false", "nullValue": NULL_TOKEN, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def write_csv(df: DataFrame, path: str) -> None:
    """Bulk text export; text columns may hold any character."""
    for name in _texts(df.schema):
        c = F.col(name)
        for plain, escaped in _ESCAPES:
            c = F.replace(c, F.lit(plain), F.lit(escaped))
        df = df.withColumn(name, c)
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    df = spark.read.schema(schema).options(**_CSV_OPTIONS).option("mode", "FAILFAST").csv(path)
    (plain, escaped), *others, (mark, mark_sequence) = _ESCAPES
    for name in _texts(schema):
        c = F.replace(F.col(name), F.lit(escaped), F.lit(_MARK))
        for text, sequence in others:
            c = F.replace(c, F.lit(sequence), F.lit(text))
        # between the marks of the text, every mark stands for a backslash
        between = F.transform(F.split(c, re.escape(mark_sequence)), lambda x: F.replace(x, F.lit(_MARK), F.lit(plain)))
        df = df.withColumn(name, F.when(F.contains(c, F.lit(mark_sequence)), F.array_join(between, mark))
                           .otherwise(F.replace(c, F.lit(_MARK), F.lit(plain))))
    return df


def new_load_id() -> str:
    from datetime import datetime, timezone
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ") + "_" + uuid.uuid4().hex[:8]


def publish_load(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, load_id: str | None = None,
                 specs: Mapping[str, TableSpec] = TABLES) -> str:
    """Write every table (parents first) under `root/loads/<id>/`, then the marker."""
    load_id = load_id or new_load_id()
    order = [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]
    for name in order:
        df = conform(tables[name], specs[name]) if name in specs else tables[name]
        df.write.mode("errorifexists").parquet(f"{root}/loads/{load_id}/{name}")
    marker = spark.createDataFrame([(load_id, order)], "load_id string, tables array<string>")
    marker.coalesce(1).write.mode("errorifexists").json(f"{root}/_committed/{load_id}")
    return load_id


def latest_load(spark: SparkSession, root: str) -> str:
    """Id of the newest committed load (ids start with a UTC stamp)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_committed")
    latest = None
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        marks = spark.read.schema("load_id string, tables array<string>").json(f"{root}/_committed/*")
        latest = marks.agg(F.max("load_id")).first()[0]
    if latest is None:
        raise FileNotFoundError(f"no committed load under {root}")
    return latest


def read_load(spark: SparkSession, root: str, table: str, load_id: str | None = None) -> DataFrame:
    load_id = load_id or latest_load(spark, root)
    return spark.read.parquet(f"{root}/loads/{load_id}/{table}")
