"""Keyed queries over the supplied tables, each with its DuckDB oracle text.

`QUERIES[key](spark, sf_dir) -> DataFrame` wires fixture views into the library
operators; `ORACLES[key]` is the independent SQL statement of the same result.
Keys without an oracle are checked on row counts only (models, streams).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitwise.sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- import the query modules so their @query decorators run ------------------------
def _load() -> None:
    from pitwise.plans import queries_eval, queries_features, queries_models, queries_quality, queries_signals  # noqa: F401


_load()
