"""Numeric expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as double, NULL where the denominator is 0."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def logit(p: Column | str) -> Column:
    p = _col(p)
    return F.ln(p / (F.lit(1.0) - p))


def logistic(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def round6(c: Column | str) -> Column:
    return F.round(_col(c), 6)


def log_factorial(n: Column | str) -> Column:
    """``ln(n!)`` of a non-negative whole number as a plain expression.

    Exact products up to 20, Stirling's series beyond (its error there is below
    1e-15), so no lookup table has to grow with the counts.
    """
    n = _col(n)
    x = n.cast("double")
    series = (
        x * F.ln(x)
        - x
        + 0.5 * F.ln(2 * math.pi * x)
        + 1 / (12 * x)
        - 1 / (360 * F.pow(x, F.lit(3.0)))
        + 1 / (1260 * F.pow(x, F.lit(5.0)))
    )
    return F.when(n <= 20, F.ln(F.factorial(F.least(n, F.lit(20)).cast("int")))).otherwise(series)


def log_choose(n: Column | str, k: Column | str) -> Column:
    """``ln(n choose k)``; NULL where k is outside 0..n."""
    n, k = _col(n), _col(k)
    return F.when(
        (k >= 0) & (k <= n), log_factorial(n) - log_factorial(k) - log_factorial(n - k)
    )
