"""Declared table model of the card-operation store.

Types, keys, references, NOT NULL columns and defaults of the operational schema.
Spark has no enforced constraints, so they become data-quality jobs
(`pitwise.operators.quality`) and the typed loader (`pitwise.sources.etl`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

D14_2 = T.DecimalType(14, 2)
D9_6 = T.DecimalType(9, 6)
TS = T.TimestampNTZType()  # wall-clock UTC, no zone conversion on read/write


def _f(name, dtype, nullable=False):
    return T.StructField(name, dtype, nullable)


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    # (column, parent table, parent column)
    references: tuple[tuple[str, str, str], ...] = ()
    defaults: dict = field(default_factory=dict)
    # layout hint for the analytical copy: cluster rows by these columns
    sort_key: tuple[str, ...] = ()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


# The declared operational schema (columns, keys, references, defaults).
TABLES: dict[str, TableSpec] = {
    "mcc_dictionary": TableSpec(
        "mcc_dictionary",
        T.StructType([_f("mcc", T.StringType()), _f("description", T.StringType()),
                      _f("category", T.StringType()), _f("base_risk", T.ShortType())]),
        ("mcc",), defaults={"base_risk": 0}, sort_key=("mcc",)),
    "customers": TableSpec(
        "customers",
        T.StructType([_f("customer_id", T.LongType()), _f("home_country", T.StringType()),
                      _f("home_city", T.StringType(), True), _f("segment", T.StringType()),
                      _f("signup_at", TS), _f("home_lat", D9_6, True), _f("home_lon", D9_6, True)]),
        ("customer_id",), sort_key=("customer_id",)),
    "cards": TableSpec(
        "cards",
        T.StructType([_f("card_id", T.LongType()), _f("customer_id", T.LongType()), _f("issued_at", TS)]),
        ("card_id",), references=(("customer_id", "customers", "customer_id"),), sort_key=("card_id",)),
    "devices": TableSpec(
        "devices",
        T.StructType([_f("device_id", T.LongType()), _f("device_type", T.StringType()),
                      _f("first_seen_at", TS)]),
        ("device_id",), sort_key=("device_id",)),
    "merchants": TableSpec(
        "merchants",
        T.StructType([_f("merchant_id", T.LongType()), _f("mcc", T.StringType()),
                      _f("merchant_country", T.StringType()), _f("descriptor", T.StringType()),
                      _f("risk_segment", T.StringType())]),
        ("merchant_id",), references=(("mcc", "mcc_dictionary", "mcc"),), sort_key=("merchant_id",)),
    "transactions": TableSpec(
        "transactions",
        T.StructType([
            _f("transaction_id", T.LongType()), _f("customer_id", T.LongType()), _f("card_id", T.LongType()),
            _f("device_id", T.LongType(), True), _f("merchant_id", T.LongType()), _f("amount", D14_2),
            _f("currency", T.StringType()), _f("country", T.StringType()), _f("city", T.StringType(), True),
            _f("channel", T.StringType()), _f("entry_mode", T.StringType()),
            _f("is_ecommerce", T.BooleanType()), _f("is_recurring", T.BooleanType()),
            _f("is_tokenized", T.BooleanType()), _f("auth_result", T.StringType()),
            _f("response_code", T.StringType(), True), _f("authorized_at", TS),
            _f("lat", D9_6, True), _f("lon", D9_6, True), _f("ip_country", T.StringType(), True)]),
        ("transaction_id",),
        references=(("customer_id", "customers", "customer_id"), ("card_id", "cards", "card_id"),
                    ("device_id", "devices", "device_id"), ("merchant_id", "merchants", "merchant_id")),
        defaults={"currency": "RUB", "is_ecommerce": False, "is_recurring": False, "is_tokenized": False},
        sort_key=("customer_id", "authorized_at")),
    "fraud_labels": TableSpec(
        "fraud_labels",
        T.StructType([_f("label_id", T.LongType()), _f("transaction_id", T.LongType()),
                      _f("label_type", T.StringType()), _f("source", T.StringType()),
                      _f("reported_at", TS)]),
        ("label_id",), unique=(("transaction_id",),),
        references=(("transaction_id", "transactions", "transaction_id"),), sort_key=("transaction_id",)),
}

# Parents before children: the order in which a multi-table load must publish.
LOAD_ORDER = ["mcc_dictionary", "customers", "cards", "devices", "merchants", "transactions", "fraud_labels"]

# Columns added by the geo/IP migration (all nullable, additive).
MIGRATION_GEO_IP = {
    "customers": ["home_lat", "home_lon"],
    "transactions": ["lat", "lon", "ip_country"],
}
