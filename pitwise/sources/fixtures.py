"""Canonical card-operation tables derived from the supplied star-schema tables.

The supplied data (TPC-H-like `orders`, `lineitem`, `customer`, `supplier`, `part`
plus an `events` stream) is mapped onto the card-operation model: one order is one
authorization, a supplier is a merchant, a part brand is a merchant category code.

Each view body is written once as SQL text with `{table}` placeholders. Spark runs it
with `spark.sql(body, **frames)` -- DataFrame arguments, no global temp views -- and
the DuckDB oracle inlines the same text as CTEs, so both sides read identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# The mapping rules below define the test fixtures; both engines share them.
FIXTURE_SQL: dict[str, str] = {
    "order_merchant": """
  SELECT l_orderkey, min(l_suppkey) AS mid FROM {lineitem} GROUP BY l_orderkey
""",
    "transactions": """
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
    o_custkey * 3 + o_orderkey % 3 AS card_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey * 2 + o_orderkey % 2 END AS device_id,
    coalesce(m.mid, 0) AS merchant_id,
    CAST(o_totalprice AS DECIMAL(14,2)) AS amount, 'RUB' AS currency,
    CASE WHEN o_orderkey % 67 = 0 THEN concat('NATION_', CAST((c_nationkey + 1) % 25 AS STRING))
         ELSE concat('NATION_', CAST(c_nationkey AS STRING)) END AS country,
    CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE concat('CITY_', CAST(c_nationkey AS STRING)) END AS city,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'ecom' WHEN '2-HIGH' THEN 'web' WHEN '3-MEDIUM' THEN 'pos'
         WHEN '5-LOW' THEN 'atm' ELSE 'mobile' END AS channel,
    CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'cnp' ELSE 'card_present' END AS entry_mode,
    o_orderpriority IN ('1-URGENT','2-HIGH') AS is_ecommerce,
    o_orderkey % 20 = 0 AS is_recurring,
    o_orderkey % 5 < 2 AS is_tokenized,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 'declined' ELSE 'approved' END AS auth_result,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN '51' END AS response_code,
    o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400) AS authorized_at,
    CAST(40 + c_nationkey + (o_orderkey % 100) / 1000.0 AS DECIMAL(9,6)) AS lat,
    CAST(30 + c_nationkey * 2 + (o_orderkey % 90) / 1000.0 AS DECIMAL(9,6)) AS lon,
    CASE WHEN o_orderpriority NOT IN ('1-URGENT','2-HIGH') THEN NULL
         WHEN o_orderkey % 41 = 0 THEN 'NATION_0'
         ELSE concat('NATION_', CAST(c_nationkey AS STRING)) END AS ip_country
  FROM {orders} JOIN {customer} ON c_custkey = o_custkey LEFT JOIN {order_merchant} m ON m.l_orderkey = o_orderkey
""",
    "fraud_labels": """
  SELECT o_orderkey + 1 AS label_id, o_orderkey AS transaction_id,
    CASE o_orderkey % 3 WHEN 0 THEN 'confirmed_fraud' WHEN 1 THEN 'chargeback' ELSE 'dispute' END AS label_type,
    CASE o_orderkey % 3 WHEN 0 THEN 'manual_investigation' WHEN 1 THEN 'chargeback' ELSE 'customer_report' END AS source,
    o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400) + INTERVAL '1' DAY * (3 + o_orderkey % 87) AS reported_at
  FROM {orders}
  WHERE (o_orderpriority = '1-URGENT' AND o_totalprice >= 400000 AND o_orderkey % 2 = 0) OR o_orderkey % 199 = 0
""",
    "merchants": """
  SELECT s_suppkey AS merchant_id, concat('Brand#', CAST(s_suppkey % 25 + 1 AS STRING)) AS mcc,
    concat('NATION_', CAST(s_nationkey AS STRING)) AS merchant_country, s_name AS descriptor,
    CASE WHEN s_suppkey % 10 = 0 THEN 'high' WHEN s_suppkey % 10 < 3 THEN 'medium' ELSE 'low' END AS risk_segment
  FROM {supplier}
""",
    "mcc_dictionary": """
  SELECT p_brand AS mcc, min(p_name) AS description, min(p_type) AS category, CAST(min(p_size) % 4 AS SMALLINT) AS base_risk
  FROM {part} GROUP BY p_brand
""",
    "customers": """
  SELECT c_custkey AS customer_id, concat('NATION_', CAST(c_nationkey AS STRING)) AS home_country,
    concat('CITY_', CAST(c_nationkey AS STRING)) AS home_city,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'private' WHEN c_mktsegment = 'BUILDING' THEN 'affluent' ELSE 'mass' END AS segment,
    TIMESTAMP '1994-01-01 00:00:00' + INTERVAL '1' DAY * (c_custkey % 300) AS signup_at,
    CAST(40 + c_nationkey AS DECIMAL(9,6)) AS home_lat, CAST(30 + c_nationkey * 2 AS DECIMAL(9,6)) AS home_lon
  FROM {customer}
""",
    "cards": """
  SELECT card_id, min(customer_id) AS customer_id, min(authorized_at) AS issued_at FROM {transactions} GROUP BY card_id
""",
    "devices": """
  SELECT device_id, CASE CAST(device_id % 4 AS INT) WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'pos' ELSE 'atm' END AS device_type,
    min(authorized_at) AS first_seen_at
  FROM {transactions} WHERE device_id IS NOT NULL GROUP BY device_id
""",
}

# Dense variant over `events` (30 days of per-user activity) for window tests.
EVENT_FIXTURE_SQL: dict[str, str] = {
    "event_transactions": """
  SELECT event_id AS transaction_id, user_id AS customer_id, CAST(event_id % 20 AS BIGINT) AS merchant_id,
    CAST(value AS DECIMAL(14,2)) AS amount, event_type AS channel,
    CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS auth_result,
    date_trunc('second', ts) AS authorized_at
  FROM {events}
""",
    # Some operations without coordinates, some abroad, some at the antipodes of where they would be.
    "located_transactions": """
  SELECT transaction_id, customer_id, card_id, authorized_at, auth_result,
    CASE WHEN transaction_id % 7 = 0 THEN NULL WHEN transaction_id % 67 = 0 THEN -lat
         WHEN transaction_id % 5 = 0 THEN lat + 8 ELSE lat END AS lat,
    CASE WHEN transaction_id % 11 = 0 THEN NULL WHEN transaction_id % 67 = 0 THEN lon - 180 ELSE lon END AS lon
  FROM {transactions}
""",
}

ALL_FIXTURE_SQL = {**FIXTURE_SQL, **EVENT_FIXTURE_SQL}

# Which other views/tables each view body reads.
_DEPS = {
    name: [t for t in (*RAW_TABLES, *ALL_FIXTURE_SQL) if "{" + t + "}" in body]
    for name, body in ALL_FIXTURE_SQL.items()
}


def raw_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(raw_path(sf_dir, name))


class Tables:
    """Lazy accessor for raw tables and fixture views of one data directory.

    `Tables(spark, sf_dir).transactions` is a plain DataFrame; nothing is computed
    until an action runs, and nothing is registered in the catalog.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in RAW_TABLES:
                self._cache[name] = raw_table(self.spark, self.sf_dir, name)
            elif name in ALL_FIXTURE_SQL:
                deps = {d: self[d] for d in _DEPS[name]}
                self._cache[name] = self.spark.sql(ALL_FIXTURE_SQL[name], **deps)
            else:
                raise KeyError(name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as e:
            raise AttributeError(name) from e


def duckdb_with_clause(names: list[str] | None = None) -> str:
    """The fixture views as one DuckDB `WITH` prefix (views in dependency order)."""
    names = list(FIXTURE_SQL) if names is None else names
    needed: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            if d in ALL_FIXTURE_SQL:
                visit(d)
        if n not in needed:
            needed.append(n)

    for n in names:
        visit(n)
    plain = {t: t for t in (*RAW_TABLES, *ALL_FIXTURE_SQL)}
    parts = [f"{n} AS ({ALL_FIXTURE_SQL[n].format(**plain).strip()})" for n in needed]
    return "WITH " + ",\n".join(parts)
