"""Registered regression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.registry import publish, query, r, two_sided_sql
from waybill.operators import regression
from waybill.operators.regression import Design


@query(f"""
SELECT p_type, CAST(regr_count(p_retailprice, p_size) AS BIGINT) AS n, {r("regr_intercept(p_retailprice, p_size)")} AS intercept,
       {r("regr_slope(p_retailprice, p_size)")} AS slope, {r("regr_r2(p_retailprice, p_size)")} AS r2 FROM part GROUP BY 1
""")
def ols_simple(t):
    return publish(regression.ols_simple(t.part, "p_retailprice", "p_size", ["p_type"]))


@query(f"""
SELECT count(p_size + p_retailprice) AS n, {r("avg(power(p_retailprice - (940 + 0.25 * p_size), 2))")} AS mse FROM part
""")
def line_mse(t):
    return publish(regression.line_mse(t.part, "p_size", "p_retailprice", 940.0, 0.25))


_PAIRS = (
    ("l_quantity", "l_extendedprice"),
    ("l_quantity", "l_discount"),
    ("l_quantity", "l_tax"),
    ("l_extendedprice", "l_discount"),
    ("l_extendedprice", "l_tax"),
    ("l_discount", "l_tax"),
)


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'corr({a}, {b})')} AS correlation FROM lineitem"
        for a, b in _PAIRS
    )
)
def correlations(t):
    return publish(
        regression.correlations(
            t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        )
    )


def _lines(t):
    return t.lineitem.select("l_extendedprice", "l_quantity", "l_discount", "l_returnflag")


def _flags(t):
    return {"l_returnflag": regression.category(t.lineitem, "l_returnflag")}


@query(f"""
WITH g AS (SELECT l_returnflag AS f, avg(l_extendedprice) AS y, avg(l_quantity) AS x, regr_sxy(l_extendedprice, l_quantity) AS sxy,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx FROM lineitem GROUP BY 1),
s AS (SELECT sum(sxy) / sum(sxx) AS slope FROM g),
a AS (SELECT f, y - slope * x AS a FROM g, s)
SELECT 'l_quantity' AS term, {r("slope", 4)} AS coefficient FROM s
UNION ALL SELECT 'intercept', {r("a", 4)} FROM a WHERE f = 'A'
UNION ALL SELECT 'l_returnflag_' || f, {r("a - (SELECT a FROM a WHERE f = 'A')", 4)} FROM a WHERE f <> 'A'
""")
def ols_dummies(t):
    fit = regression.ols(_lines(t), "l_extendedprice", Design(["l_quantity"], _flags(t)))
    return publish(fit.coefficients.select("term", "coefficient"), 4)


def _open(t):
    return t.lineitem.selectExpr(
        "l_extendedprice", "l_quantity", "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open"
    )


_INTERACTED = Design(["l_quantity", "is_open"], interactions=[("l_quantity", "is_open")])


@query(f"""
WITH g AS (SELECT l_linestatus AS s, regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b
           FROM lineitem GROUP BY 1),
p AS (SELECT f.a AS a0, f.b AS b0, o.a AS a1, o.b AS b1 FROM g f, g o WHERE f.s = 'F' AND o.s = 'O')
SELECT 'intercept' AS term, {r("a0", 4)} AS coefficient FROM p UNION ALL SELECT 'l_quantity', {r("b0", 4)} FROM p
UNION ALL SELECT 'is_open', {r("a1 - a0", 4)} FROM p UNION ALL SELECT 'l_quantity:is_open', {r("b1 - b0", 4)} FROM p
""")
def ols_interactions(t):
    fit = regression.ols(_open(t), "l_extendedprice", _INTERACTED)
    return publish(fit.coefficients.select("term", "coefficient"), 4)


@query(f"""
WITH g AS (SELECT l_returnflag AS f, count(*) AS n, avg(l_extendedprice) AS y, avg(l_quantity) AS x, avg(l_discount) AS z,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_sxx(l_extendedprice, l_discount) AS szz,
                  regr_sxy(l_quantity, l_discount) AS sxz, regr_sxy(l_extendedprice, l_quantity) AS sxy,
                  regr_sxy(l_extendedprice, l_discount) AS szy, regr_syy(l_extendedprice, l_quantity) AS syy
           FROM lineitem GROUP BY 1),
s AS (SELECT sum(n) AS n, sum(sxx) AS sxx, sum(szz) AS szz, sum(sxz) AS sxz, sum(sxy) AS sxy, sum(szy) AS szy, sum(syy) AS syy FROM g),
b AS (SELECT *, (sxy * szz - szy * sxz) / (sxx * szz - sxz * sxz) AS bx, (szy * sxx - sxy * sxz) / (sxx * szz - sxz * sxz) AS bz FROM s),
e AS (SELECT *, (syy - bx * sxy - bz * szy) / (n - 5) AS s2 FROM b),
a AS (SELECT f, y - bx * x - bz * z AS a FROM g, b)
SELECT 'l_quantity' AS term, {r("bx", 4)} AS coefficient, {r("sqrt(s2 * szz / (sxx * szz - sxz * sxz))", 4)} AS std_error FROM e
UNION ALL SELECT 'l_discount', {r("bz", 4)}, {r("sqrt(s2 * sxx / (sxx * szz - sxz * sxz))", 4)} FROM e
UNION ALL SELECT 'intercept', {r("a", 4)}, NULL FROM a WHERE f = 'A'
UNION ALL SELECT 'l_returnflag_' || f, {r("a - (SELECT a FROM a WHERE f = 'A')", 4)}, NULL FROM a WHERE f <> 'A'
""")
def ols_full(t):
    fit = regression.ols(
        _lines(t), "l_extendedprice", Design(["l_quantity", "l_discount"], _flags(t))
    )
    numeric = F.col("term").isin("l_quantity", "l_discount")
    return publish(
        fit.coefficients.select(
            "term", "coefficient", F.when(numeric, F.col("std_error")).alias("std_error")
        ),
        4,
    )


@query()
def ols_summary(t):
    """The whole coefficient table: errors, t and p values included."""
    fit = regression.ols(
        _lines(t), "l_extendedprice", Design(["l_quantity", "l_discount"], _flags(t))
    )
    return publish(fit.coefficients, 4)


@query(f"""
SELECT 'simple' AS model, 'l_quantity' AS term, {r("regr_slope(l_extendedprice, l_quantity)", 4)} AS coefficient,
       {r("regr_r2(l_extendedprice, l_quantity)")} AS r2 FROM lineitem
UNION ALL SELECT 'simple', 'intercept', {r("regr_intercept(l_extendedprice, l_quantity)", 4)},
       {r("regr_r2(l_extendedprice, l_quantity)")} FROM lineitem
UNION ALL SELECT 'flags', 'intercept', {r("avg(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END)", 4)},
       {r('''1 - (SELECT sum(power(l_extendedprice - m, 2)) FROM lineitem JOIN (SELECT l_returnflag, avg(l_extendedprice) AS m
            FROM lineitem GROUP BY 1) USING (l_returnflag)) / (var_pop(l_extendedprice) * count(*))''')} FROM lineitem
UNION ALL SELECT 'flags', 'l_returnflag_' || f, {r("y - (SELECT avg(l_extendedprice) FROM lineitem WHERE l_returnflag = 'A')", 4)},
       {r('''1 - (SELECT sum(power(l_extendedprice - m, 2)) FROM lineitem JOIN (SELECT l_returnflag, avg(l_extendedprice) AS m
            FROM lineitem GROUP BY 1) USING (l_returnflag)) / (SELECT var_pop(l_extendedprice) * count(*) FROM lineitem)''')}
FROM (SELECT l_returnflag AS f, avg(l_extendedprice) AS y FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1)
""")
def compare_models(t):
    lines = _lines(t)
    fits = {
        "simple": regression.ols(lines, "l_extendedprice", Design(["l_quantity"])),
        "flags": regression.ols(lines, "l_extendedprice", Design((), _flags(t))),
    }
    out = regression.compare_models(fits).drop("std_error")
    return publish(out, 4, r2=6)


@query(f"""
SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, {r("regr_r2(l_extendedprice, l_quantity)", 9)} AS r2,
       {r("1 - (1 - regr_r2(l_extendedprice, l_quantity)) * (count(*) - 1) / (count(*) - 2)", 9)} AS adjusted_r2,
       {r("(1 - regr_r2(l_extendedprice, l_quantity)) * var_pop(l_extendedprice)", 0)} AS mse FROM lineitem
""")
def fit_quality(t):
    fit = regression.ols(_lines(t), "l_extendedprice", Design(["l_quantity"]))
    return publish(fit.quality, 9, mse=0)


@query(f"""
WITH f AS (SELECT regr_intercept(p_retailprice, p_size) AS a, regr_slope(p_retailprice, p_size) AS b FROM part)
SELECT p_partkey, {r("a + b * p_size", 4)} AS fitted, {r("p_retailprice - (a + b * p_size)", 4)} AS residual FROM part, f
""")
def fitted_values(t):
    parts = t.part.select("p_partkey", "p_retailprice", "p_size")
    fit = regression.ols(parts, "p_retailprice", Design(["p_size"]))
    return publish(fit.predict(parts).select("p_partkey", "fitted", "residual"), 4)


def _binary(t):
    return t.lineitem.selectExpr(
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned",
        "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open",
        "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS bulky",
    )


_2X2 = """c AS (
  SELECT CAST(sum(CASE WHEN e AND o THEN 1 ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN e AND NOT o THEN 1 ELSE 0 END) AS DOUBLE) AS b,
         CAST(sum(CASE WHEN NOT e AND o THEN 1 ELSE 0 END) AS DOUBLE) AS c, CAST(sum(CASE WHEN NOT e AND NOT o THEN 1 ELSE 0 END) AS DOUBLE) AS d
  FROM (SELECT l_linestatus = 'O' AS e, l_returnflag = 'R' AS o FROM lineitem))"""


@query(f"""
WITH {_2X2}
SELECT 'is_open' AS term, {r("ln((a / b) / (c / d))")} AS coefficient, {r("sqrt(1 / a + 1 / b + 1 / c + 1 / d)")} AS std_error FROM c
UNION ALL SELECT 'intercept', {r("ln(c / d)")}, {r("sqrt(1 / c + 1 / d)")} FROM c
""")
def logit_fit(t):
    fit = regression.logit_fit(_binary(t), "returned", ["is_open"])
    return publish(fit.select("term", "coefficient", "std_error"))


@query(f"""
SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open, count(*) AS n,
       {r("avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)", 4)} AS probability FROM lineitem GROUP BY 1
""")
def logistic_scores(t):
    scored = regression.logistic_scores(_binary(t), "returned", ["is_open"])
    return publish(
        scored.groupBy("is_open").agg(
            F.count(F.lit(1)).alias("n"), F.avg("probability").alias("probability")
        ),
        4,
    )


@query(f"""
WITH RECURSIVE c AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0 END AS o, CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0 END AS b,
         CAST(count(*) AS DOUBLE) AS n, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS k FROM lineitem GROUP BY 1, 2),
it AS (
  SELECT 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS v0, 0.0::DOUBLE AS v1, 0.0::DOUBLE AS v2
  UNION ALL
  SELECT i + 1, b0 + (c00 * g0 + c01 * g1 + c02 * g2) / det, b1 + (c01 * g0 + c11 * g1 + c12 * g2) / det,
         b2 + (c02 * g0 + c12 * g1 + c22 * g2) / det, c00 / det, c11 / det, c22 / det
  FROM (SELECT *, h11 * h22 - h12 * h12 AS c00, h02 * h12 - h01 * h22 AS c01, h01 * h12 - h02 * h11 AS c02, h00 * h22 - h02 * h02 AS c11,
               h01 * h02 - h00 * h12 AS c12, h00 * h11 - h01 * h01 AS c22,
               h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
        FROM (SELECT i, b0, b1, b2, sum(k - n * p) AS g0, sum((k - n * p) * o) AS g1, sum((k - n * p) * b) AS g2, sum(n * p * (1 - p)) AS h00,
                     sum(n * p * (1 - p) * o) AS h01, sum(n * p * (1 - p) * b) AS h02, sum(n * p * (1 - p) * o) AS h11,
                     sum(n * p * (1 - p) * o * b) AS h12, sum(n * p * (1 - p) * b) AS h22
              FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * o + b2 * b))) AS p FROM it, c WHERE i < 20) GROUP BY i, b0, b1, b2))),
e AS (SELECT unnest(['intercept', 'is_open', 'bulky']) AS term, unnest([b0, b1, b2]) AS a, unnest([sqrt(v0), sqrt(v1), sqrt(v2)]) AS s FROM it WHERE i = 20)
SELECT term, {r("a")} AS coefficient, {r("s")} AS std_error, {r("a / s", 4)} AS statistic, {r(two_sided_sql("a / s"))} AS p_value,
       {r("exp(a)")} AS odds_ratio, {r("exp(a - 1.959963984540054 * s)")} AS odds_low, {r("exp(a + 1.959963984540054 * s)")} AS odds_high,
       true AS converged, false AS separated FROM e
""")
def logit_two_factors(t):
    fit = regression.logit_fit(_binary(t), "returned", ["is_open", "bulky"])
    return publish(fit.drop("iterations"), statistic=4)
