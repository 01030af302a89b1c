"""Registration of queries and their oracles, and the shape of published results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waybill.sources import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable:
    """Register a function of ``Tables`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, directory: fn(Tables(spark, directory))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def publish(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Result columns as plain types: dates as ISO text, decimals and doubles rounded.

    ``special`` gives other digits for single columns.
    """
    out = []
    for name, kind in df.dtypes:
        c = f"`{name}`"
        if kind in ("double", "float"):
            c = f"round({c}, {special.get(name, digits)}) + 0.0D"
        elif kind.startswith("decimal"):
            c = f"cast({c} AS double)"
        elif kind == "date":
            c = f"date_format({c}, 'yyyy-MM-dd')"
        elif kind.startswith("timestamp"):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        out.append(f"{c} AS `{name}`")
    return df.selectExpr(*out)


def upper_gamma_sql(a: str, x: str) -> str:
    """SQL text for Q(a, x): one less the power series of the lower incomplete gamma function."""
    series = f"list_sum(list_transform(range(0, 2500), lambda i: exp((i + {a}) * ln({x}) - {x} - lgamma(i + {a} + 1))))"
    return f"(CASE WHEN {x} <= 0 THEN 1.0 WHEN {x} > 600 THEN 0.0 ELSE greatest(0.0, 1 - {series}) END)"


def digamma_sql(a: str) -> str:
    """SQL text for the digamma function: asymptotic series at a + 8 and the recurrence."""
    z = f"({a} + 8)"
    series = f"ln({z}) - 0.5 / {z} - 1 / (12 * power({z}, 2)) + 1 / (120 * power({z}, 4)) - 1 / (252 * power({z}, 6)) + 1 / (240 * power({z}, 8))"
    return "(" + series + "".join(f" - 1 / ({a} + {k})" for k in range(8)) + ")"


def trigamma_sql(a: str) -> str:
    """SQL text for the trigamma function."""
    z = f"({a} + 8)"
    series = f"1 / {z} + 1 / (2 * power({z}, 2)) + 1 / (6 * power({z}, 3)) - 1 / (30 * power({z}, 5)) + 1 / (42 * power({z}, 7)) - 1 / (30 * power({z}, 9))"
    return "(" + series + "".join(f" + 1 / power({a} + {k}, 2)" for k in range(8)) + ")"


def gamma_newton_sql(source: str, name: str, keys: str) -> str:
    """Recursive SQL of Newton steps for the gamma shape from ``mean`` and ``lm`` of ``source``."""
    return f"""{name} AS (
  SELECT {keys}, mean, lm, 0 AS i, (3 - (ln(mean) - lm) + sqrt(power(ln(mean) - lm - 3, 2) + 24 * (ln(mean) - lm))) / (12 * (ln(mean) - lm)) AS k
  FROM {source}
  UNION ALL
  SELECT {keys}, mean, lm, i + 1, k - (ln(k) - {digamma_sql("k")} - (ln(mean) - lm)) / (1 / k - {trigamma_sql("k")}) FROM {name} WHERE i < 12)"""


def two_sided_sql(z: str) -> str:
    """SQL text for P(|Z| > |z|) of the standard normal."""
    return upper_gamma_sql("0.5", f"(({z}) * ({z}) / 2)")


def r(expression: str, digits: int = 6) -> str:
    """SQL text for a rounded double without negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0)"
