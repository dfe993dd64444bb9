"""Keyed queries: constraint checks, typed reload, CSV round trip, schema
evolution, defaults, dataset profiles and surrogate ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwise import oracles as O
from pitwise.operators import quality as Q
from pitwise.operators.ordering import assign_ids
from pitwise.operators.windows import customer_window_features
from pitwise.registry import query
from pitwise.session import new_scratch
from pitwise.sources import etl
from pitwise.sources.schemas import LOAD_ORDER, MIGRATION_GEO_IP, TABLES

CANONICAL = LOAD_ORDER


def _canonical(t):
    return {n: t[n] for n in CANONICAL}


# ---------------------------------------------------------------- constraint checks


def _unique_sql(table: str, keys: tuple[str, ...]) -> str:
    k = ", ".join(keys)
    return (f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, CAST(sum(n) AS BIGINT) AS n_rows, "
            f"count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_duplicate_keys, "
            f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS n_surplus_rows "
            f"FROM (SELECT {k}, count(*) AS n FROM {table} GROUP BY {k}) x")


_UNIQUE_PARTS = [_unique_sql(n, s.primary_key) for n, s in TABLES.items()] + [
    _unique_sql(n, u) for n, s in TABLES.items() for u in s.unique] + [
    _unique_sql("lineitem", ("l_orderkey", "l_linenumber"))]


@query("dq_unique", O.sql("\nUNION ALL\n".join(_UNIQUE_PARTS)))
def q_dq_unique(t):
    """Primary-key / UNIQUE check of every canonical table plus the raw line items."""
    rep = Q.check_unique(_canonical(t))
    return rep.unionByName(Q.unique_summary(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]))


_FK_PARTS = [
    (f"SELECT '{n}' AS child_table, '{c}' AS fk_column, '{p}' AS parent_table, '{pk}' AS pk_column, "
     f"count(*) AS n_orphans, count(DISTINCT x.{c}) AS n_orphan_keys FROM {n} x "
     f"WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{c})")
    for n, s in TABLES.items() for c, p, pk in s.references]


@query("dq_foreign_key", O.sql("\nUNION ALL\n".join(_FK_PARTS)))
def q_dq_foreign_key(t):
    return Q.check_foreign_keys(_canonical(t))


_NN_PARTS = [f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM {n}"
             for n, s in TABLES.items() for c in s.not_null]


@query("dq_not_null", O.sql("\nUNION ALL\n".join(_NN_PARTS)))
def q_dq_not_null(t):
    return Q.check_not_null(_canonical(t))


# ---------------------------------------------------------------- defaults / evolution / reload


@query("apply_defaults", O.sql("""
SELECT transaction_id, CASE WHEN transaction_id % 3 = 0 THEN 'EUR' ELSE 'RUB' END AS currency,
  transaction_id % 5 = 0 AS is_ecommerce, false AS is_recurring, transaction_id % 7 = 0 AS is_tokenized
FROM event_transactions""", views=["event_transactions"]))
def q_apply_defaults(t):
    """A source whose currency and flags are partly set, loaded with the declared defaults."""
    set_ = {"currency": (3, "EUR"), "is_ecommerce": (5, True), "is_tokenized": (7, True)}
    spec = TABLES["transactions"]
    src = t.event_transactions.select("transaction_id")
    for c in spec.defaults:
        every, value = set_.get(c, (0, None))
        known = F.when(F.col("transaction_id") % every == 0, F.lit(value)) if every else F.lit(None)
        src = src.withColumn(c, known.cast(spec.schema[c].dataType))
    return Q.apply_defaults(src, spec.defaults)


MIGRATED_AT = "1995-01-01 00:00:00"  # parameter: when the geo/IP migration went live


@query("schema_evolve", O.sql(f"""
SELECT transaction_id,
  CASE WHEN authorized_at >= TIMESTAMP '{MIGRATED_AT}' THEN lat END AS lat,
  CASE WHEN authorized_at >= TIMESTAMP '{MIGRATED_AT}' THEN lon END AS lon,
  CASE WHEN authorized_at >= TIMESTAMP '{MIGRATED_AT}' THEN ip_country END AS ip_country
FROM transactions"""))
def q_schema_evolve(t):
    """Files written before the additive migration lack the new columns; files of both
    generations are read as one declared table."""
    spec = TABLES["transactions"]
    tx = etl.conform(t.transactions, spec)
    cut = F.lit(MIGRATED_AT).cast("timestamp_ntz")
    path = new_scratch(t.spark, "generations")
    old = tx.filter(F.col("authorized_at") < cut).drop(*MIGRATION_GEO_IP["transactions"])
    old.write.parquet(path)
    tx.filter(F.col("authorized_at") >= cut).select(*reversed(tx.columns)).write.mode("append").parquet(path)
    return etl.read_generations(t.spark, path, spec).select("transaction_id", *MIGRATION_GEO_IP["transactions"])


_TX_COLS = ", ".join(f.name for f in TABLES["transactions"].schema.fields)


@query("etl_reload", O.sql(f"SELECT {_TX_COLS} FROM transactions"))
def q_etl_reload(t):
    """The transactions table reloaded twice (the second load replaces the first) and read back."""
    spec = TABLES["transactions"]
    path = new_scratch(t.spark, "reload")
    for _ in range(2):
        etl.reload_table(t.transactions, spec, path)
    return t.spark.read.parquet(path)


@query("velocity_bucketed", O.sql("SELECT transaction_id, customer_id, vel_1h, vel_24h, vel_7d FROM feat", O.window_cte()))
def q_velocity_bucketed(t):
    """Velocity over the bucketed analytical copy: the table is written once, the windows need no shuffle."""
    path = new_scratch(t.spark, "bucketed")
    name = "transactions_" + path.rsplit("-", 1)[1]
    copy = etl.save_bucketed(t.transactions, TABLES["transactions"], name, path, buckets=8)
    return customer_window_features(copy).select("transaction_id", "customer_id", "vel_1h", "vel_24h", "vel_7d")


@query("csv_roundtrip", O.sql(f"SELECT {_TX_COLS} FROM transactions"))
def q_csv_roundtrip(t):
    """Bulk text export (no header, NULL as \\N) and typed re-read."""
    spec = TABLES["transactions"]
    path = new_scratch(t.spark, "csv-roundtrip")
    etl.write_csv(etl.conform(t.transactions, spec), path)
    return etl.read_csv(t.spark, path, spec.schema)


# ---------------------------------------------------------------- dataset profiles


@query("first_seen", O.sql("""
SELECT t.customer_id, min(t.authorized_at) AS first_op_at,
  min(CASE WHEN fl.transaction_id IS NULL THEN t.authorized_at END) AS first_legit_at,
  CAST(min(CASE WHEN fl.transaction_id IS NULL THEN t.authorized_at END) AS DATE) AS first_legit_day
FROM transactions t LEFT JOIN fraud_labels fl ON fl.transaction_id = t.transaction_id
GROUP BY t.customer_id"""))
def q_first_seen(t):
    """Per customer: first operation and first legitimate (never reported) operation."""
    lab = t.fraud_labels.select(F.col("transaction_id").alias("__lk"))
    j = t.transactions.join(lab, F.col("transaction_id") == F.col("__lk"), "left")
    legit_ts = F.when(F.col("__lk").isNull(), F.col("authorized_at"))
    return j.groupBy("customer_id").agg(
        F.min("authorized_at").alias("first_op_at"),
        F.min(legit_ts).alias("first_legit_at"),
        F.min(legit_ts).cast("date").alias("first_legit_day"))


@query("class_profile", O.sql("""
SELECT CASE WHEN fl.transaction_id IS NOT NULL THEN 1 ELSE 0 END AS is_fraud, count(*) AS n,
  round(avg(CAST(t.amount AS DOUBLE)), 4) AS mean_amount,
  round(100.0::DOUBLE * avg(CASE WHEN t.country <> c.home_country THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS pct_foreign,
  round(100.0::DOUBLE * avg(CASE WHEN hour(t.authorized_at) < 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS pct_night
FROM transactions t JOIN customers c ON c.customer_id = t.customer_id
LEFT JOIN fraud_labels fl ON fl.transaction_id = t.transaction_id
GROUP BY 1"""))
def q_class_profile(t):
    """Fraud vs legitimate: mean amount, share abroad, share at night (hour < 6)."""
    lab = t.fraud_labels.select(F.col("transaction_id").alias("__lk"))
    cust = t.customers.select(F.col("customer_id").alias("__cid"), "home_country")
    j = (t.transactions.join(cust, F.col("customer_id") == F.col("__cid"), "inner")
         .join(lab, F.col("transaction_id") == F.col("__lk"), "left"))
    share = lambda pred: F.round(F.lit(100.0) * F.avg(F.when(pred, 1.0).otherwise(0.0)), 3)
    return j.groupBy(F.when(F.col("__lk").isNotNull(), 1).otherwise(0).alias("is_fraud")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("amount").cast("double")), 4).alias("mean_amount"),
        share(F.col("country") != F.col("home_country")).alias("pct_foreign"),
        share(F.hour("authorized_at") < 6).alias("pct_night"))


@query("assign_ids", O.sql("""
SELECT transaction_id, row_number() OVER (ORDER BY authorized_at, transaction_id) - 1 AS row_id
FROM transactions"""))
def q_assign_ids(t):
    """Surrogate ids in global time order (range partitioning + partition offsets)."""
    tx = t.transactions.select("transaction_id", "authorized_at")
    return assign_ids(tx, ["authorized_at", "transaction_id"]).select("transaction_id", "row_id")
