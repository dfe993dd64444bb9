"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(pred) -> Column:
    """Boolean predicate -> 0/1 int, NULL predicate counts as 0."""
    return F.when(as_col(pred), F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num, den) -> Column:
    """num / den as double, 0.0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(as_col(num).cast("double"), as_col(den).cast("double")), F.lit(0.0))


def shrunk_rate(n_pos, n, prior: float = 0.004, strength: float = 500.0) -> Column:
    """Bayesian shrinkage of a rate toward `prior` with `strength` pseudo-observations."""
    return (as_col(n_pos).cast("double") + F.lit(float(strength) * float(prior))) / (
        as_col(n).cast("double") + F.lit(float(strength)))
