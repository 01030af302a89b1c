"""Tail probabilities as column expressions.

Spark SQL has no gamma or error function. The regularised incomplete gamma function is a power series
below its turning point and a continued fraction above, each a fold over a sequence whose length follows
from the shape; both agree with closed forms to about twelve digits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_gamma(a: Column | str) -> Column:
    """``ln(gamma(a))`` for a > 0: Stirling's series at a + 8, brought back by the recurrence."""
    a = _col(a).cast("double")
    z = a + 8
    product = a
    for k in range(1, 8):
        product = product * (a + k)
    one = F.lit(1.0) / z
    square = one * one
    tail = one * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188))))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + tail - F.ln(product)


def digamma(a: Column | str) -> Column:
    """Derivative of ``log_gamma``, by the asymptotic series at a + 8 and the recurrence."""
    a = _col(a).cast("double")
    z = a + 8
    square = F.lit(1.0) / (z * z)
    out = F.ln(z) - 0.5 / z - square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square / 240)))
    for k in range(8):
        out = out - F.lit(1.0) / (a + k)
    return out


def trigamma(a: Column | str) -> Column:
    """Derivative of ``digamma``."""
    a = _col(a).cast("double")
    z = a + 8
    square = F.lit(1.0) / (z * z)
    out = F.lit(1.0) / z + square / 2 + square / z * (1 / 6 - square * (1 / 30 - square * (1 / 42 - square / 30)))
    for k in range(8):
        out = out + F.lit(1.0) / ((a + k) * (a + k))
    return out


def _series(a: Column, x: Column) -> Column:
    """Sum of x^n / (a (a+1) ... (a+n))."""
    n = (F.lit(60) + F.ceil(10 * F.sqrt(a))).cast("int")
    start = F.struct((F.lit(1.0) / a).alias("term"), (F.lit(1.0) / a).alias("sum"))

    def step(s: Column, k: Column) -> Column:
        term = s["term"] * x / (a + k)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["sum"])


def _fraction(a: Column, x: Column) -> Column:
    """The continued fraction of the upper incomplete gamma function, by its modified Lentz form."""
    n = (F.lit(200) + F.ceil(10 * F.sqrt(a))).cast("int")
    b = x + 1 - a
    start = F.struct(F.lit(1e300).alias("c"), (F.lit(1.0) / b).alias("d"), (F.lit(1.0) / b).alias("h"))

    def step(s: Column, k: Column) -> Column:
        factor = -k * (k - a)
        width = b + 2 * k
        c = width + factor / s["c"]
        d = F.lit(1.0) / (factor * s["d"] + width)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["h"])


def upper_gamma(a: Column | str, x: Column | str) -> Column:
    """The regularised upper incomplete gamma function Q(a, x); 1 for x <= 0, NULL for NULL."""
    a, x = _col(a).cast("double"), _col(x).cast("double")
    scale = F.exp(a * F.ln(x) - x - log_gamma(a))
    return (
        F.when(x <= 0, 1.0)
        .when(x < a + 1, F.greatest(F.lit(0.0), 1 - scale * _series(a, x)))
        .when(x > 1e5 + 10 * a, 0.0)
        .otherwise(F.when(x.isNotNull() & a.isNotNull(), F.least(F.lit(1.0), scale * _fraction(a, x))))
    )


def chi2_sf(x: Column | str, dof: Column | str) -> Column:
    """P(chi-square with ``dof`` > x); NaN without a statistic or with less than one degree of freedom."""
    x, dof = _col(x).cast("double"), _col(dof).cast("double")
    known = x.isNotNull() & ~F.isnan(x) & (dof >= 1)
    return F.when(known, upper_gamma(dof / 2, x / 2)).otherwise(float("nan"))


def normal_two_sided(z: Column | str) -> Column:
    """P(|Z| > |z|) of the standard normal."""
    z = _col(z).cast("double")
    return F.when(F.isnan(z), z).otherwise(upper_gamma(F.lit(0.5), z * z / 2))


def normal_cdf(z: Column | str) -> Column:
    """P(Z <= z) of the standard normal."""
    z = _col(z).cast("double")
    half = normal_two_sided(z) / 2
    return F.when(z < 0, half).otherwise(1 - half)
