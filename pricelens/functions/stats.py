"""Statistics with the reference's conventions, as Spark aggregate expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skew(c: Column) -> Column:
    """Bias-adjusted sample skewness (pandas ``skew``): g1 * sqrt(n (n-1)) / (n - 2) (T5).

    Spark's ``skewness`` (population g1, numerically stable central moments,
    one partial aggregation) times the small-sample factor.
    """
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def half_even(c: Column, dp: int = 0) -> Column:
    """Python ``round`` semantics (banker's rounding, T11)."""
    return F.bround(c, dp)
