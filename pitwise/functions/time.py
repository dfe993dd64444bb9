"""Time helpers (session time zone is UTC; see `pitwise.session.REQUIRED_CONF`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitwise.functions.cols import as_col


def epoch_seconds(ts) -> Column:
    """Whole unix seconds of a timestamp (NTZ or LTZ) column."""
    return F.unix_seconds(as_col(ts).cast("timestamp"))


def monday(ts) -> Column:
    """Monday 00:00 of the week containing `ts`, as a DATE."""
    return F.date_trunc("week", as_col(ts)).cast("date")


def days_back(ts, days: int) -> Column:
    """`ts - INTERVAL days DAYS`, keeping the NTZ type of `ts`."""
    return as_col(ts) - F.make_dt_interval(days=F.lit(int(days)))


def add_weeks(d, k) -> Column:
    """DATE `d` plus `k` weeks (`k` may be a column)."""
    return F.date_add(as_col(d), (as_col(k) * 7).cast("int"))
