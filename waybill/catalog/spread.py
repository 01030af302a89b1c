"""Registered distribution and survival queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog import views as v
from waybill.catalog.registry import digamma_sql, gamma_newton_sql, publish, query, r, trigamma_sql
from waybill.operators import distributions, ordered, quality, survival


@query(f"""
WITH {v.INVOICES_SQL}, k AS (SELECT * FROM invoices WHERE issued_at >= TIMESTAMP '2000-01-01' AND issued_at < TIMESTAMP '2000-07-01'),
m AS (SELECT currency, avg(revenue) AS mu FROM k GROUP BY 1),
c AS (SELECT currency, revenue, revenue - mu AS d FROM k JOIN m USING (currency))
SELECT currency, count(*) AS n, {r("avg(CASE WHEN revenue BETWEEN 1000 AND 2000 THEN 1.0 ELSE 0.0 END)")} AS p_between,
       {r("avg(revenue)", 3)} AS mean, {r("sqrt(avg(d * d))", 3)} AS std,
       {r("avg(d * d * d) / power(avg(d * d), 1.5)")} AS skewness, {r("avg(d * d * d * d) / power(avg(d * d), 2) - 3")} AS kurtosis
FROM c GROUP BY 1
""")
def category_probability(t):
    from waybill.plans.invoicing import invoice_details

    details = invoice_details(v.invoices(t), "2000-01-01", "2000-07-01")
    shares = quality.rate(
        details, ["currency"], F.col("revenue").between(1000, 2000), "p_between"
    )
    shape = distributions.moments(details, "revenue", ["currency"]).select(
        "currency", "mean", F.sqrt("var_pop").alias("std"), "skewness", "kurtosis"
    )
    return publish(shares.join(shape, "currency"), mean=3, std=3)


@query(f"""
WITH {v.INVOICES_SQL}, k AS (SELECT * FROM invoices WHERE issued_at >= TIMESTAMP '2000-01-01' AND issued_at < TIMESTAMP '2000-07-01')
SELECT 'issuing_entity' AS column_name, issuing_entity AS value, count(*) AS n, {r("count(*) / (SELECT count(*) FROM k)::DOUBLE")} AS share
FROM k GROUP BY 2
UNION ALL SELECT 'currency', currency, count(*), {r("count(*) / (SELECT count(*) FROM k)::DOUBLE")} FROM k GROUP BY 2
""")
def entity_and_currency_shares(t):
    from waybill.plans.invoicing import invoice_details

    details = invoice_details(v.invoices(t), "2000-01-01", "2000-07-01")
    return publish(quality.category_shares(details, ["issuing_entity", "currency"]))


@query(f"""
WITH c AS (SELECT value AS x, count(*) AS n FROM events GROUP BY 1)
SELECT {r("x")} AS x, n, {r("n / sum(n) OVER ()", 9)} AS pmf, {r("sum(n) OVER (ORDER BY x) / sum(n) OVER ()", 9)} AS cdf FROM c
""")
def empirical_cdf(t):
    return publish(distributions.empirical(t.events, "value"), 9, x=6)


@query(f"""
WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mu FROM lineitem GROUP BY 1),
c AS (SELECT l_returnflag, l_quantity, l_quantity - mu AS d FROM lineitem JOIN m USING (l_returnflag))
SELECT l_returnflag, count(*) AS n, {r("avg(l_quantity)")} AS mean, {r("avg(d * d)")} AS var_pop,
       {r("sum(d * d) / (count(*) - 1)")} AS var_samp, {r("avg(d * d * d) / power(avg(d * d), 1.5)")} AS skewness,
       {r("avg(d * d * d * d) / power(avg(d * d), 2) - 3")} AS kurtosis FROM c GROUP BY 1
""")
def moments(t):
    return publish(distributions.moments(t.lineitem, "l_quantity", ["l_returnflag"]))


@query(f"""
WITH RECURSIVE s AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS mean, avg(ln(l_extendedprice)) AS lm FROM lineitem GROUP BY 1),
{gamma_newton_sql("s", "it", "l_returnflag")}
SELECT l_returnflag, n, {r("k")} AS shape, {r("it.mean / k", 3)} AS scale,
       {r("n * ((k - 1) * it.lm - k - k * ln(it.mean / k) - lgamma(k))", 2)} AS log_likelihood FROM it JOIN s USING (l_returnflag) WHERE i = 12
""")
def gamma_fit(t):
    return publish(distributions.gamma_fit(t.lineitem, "l_extendedprice", ["l_returnflag"]), scale=3, log_likelihood=2)


@query(f"""
WITH RECURSIVE x AS (SELECT l_quantity / 51.0::DOUBLE AS x FROM lineitem WHERE l_quantity / 51.0::DOUBLE BETWEEN 1e-12 AND 0.999999999999),
s AS (SELECT count(*) AS n, avg(x) AS mean, var_pop(x) AS var, avg(ln(x)) AS l, avg(ln(1 - x)) AS r FROM x),
it AS (
  SELECT 0 AS i, l, r, n, mean * (mean * (1 - mean) / var - 1) AS a, (1 - mean) * (mean * (1 - mean) / var - 1) AS b FROM s
  UNION ALL
  SELECT i + 1, l, r, n, a - (g * (tc - tb) - h * tc) / ((tc - ta) * (tc - tb) - tc * tc), b - (h * (tc - ta) - g * tc) / ((tc - ta) * (tc - tb) - tc * tc)
  FROM (SELECT *, {trigamma_sql("a")} AS ta, {trigamma_sql("b")} AS tb, {trigamma_sql("(a + b)")} AS tc,
               {digamma_sql("(a + b)")} - {digamma_sql("a")} + l AS g, {digamma_sql("(a + b)")} - {digamma_sql("b")} + r AS h FROM it WHERE i < 12))
SELECT n, {r("a")} AS a, {r("b")} AS b, {r("n * ((a - 1) * l + (b - 1) * r + lgamma(a + b) - lgamma(a) - lgamma(b))", 3)} AS log_likelihood FROM it WHERE i = 12
""")
def beta_fit(t):
    share = t.lineitem.select((F.col("l_quantity") / 51.0).alias("x"))
    return publish(distributions.beta_fit(share, "x"), log_likelihood=3)


@query(f"""
WITH RECURSIVE x AS (SELECT l_quantity::DOUBLE AS x, count(*) AS n FROM lineitem WHERE l_quantity > 0 GROUP BY 1),
t AS (SELECT max(x) AS top, sum(n) AS n, sum(n * ln(x)) / sum(n) AS lm FROM x),
it AS (
  SELECT 0 AS i, 1.0::DOUBLE AS k
  UNION ALL
  SELECT i + 1, k - (s1 / s0 - 1 / k - (lm - ln(top))) / (s2 / s0 - power(s1 / s0, 2) + 1 / (k * k))
  FROM (SELECT i, k, lm, top, sum(x.n * power(x / top, k)) AS s0, sum(x.n * power(x / top, k) * ln(x / top)) AS s1,
               sum(x.n * power(x / top, k) * power(ln(x / top), 2)) AS s2 FROM it, t, x WHERE i < 20 GROUP BY i, k, lm, top)),
f AS (SELECT k, t.n, lm, top * power((SELECT sum(x.n * power(x / top, k)) FROM x) / t.n, 1 / k) AS scale FROM it, t WHERE i = 20)
SELECT CAST(n AS BIGINT) AS n, {r("k")} AS shape, {r("scale")} AS scale, {r("n * (ln(k) - k * ln(scale) + (k - 1) * lm - 1)", 3)} AS log_likelihood FROM f
""")
def weibull_fit(t):
    return publish(distributions.weibull_fit(t.lineitem, "l_quantity").drop("steps"), log_likelihood=3)


@query(f"""
SELECT count(*) AS n, {r("avg(abs(value - (SELECT avg(value) FROM events)))")} AS mean_abs_deviation FROM events
""")
def mean_abs_deviation(t):
    return publish(distributions.mean_absolute_deviation(t.events, "value"))


@query(f"""
WITH s AS (SELECT avg(l_quantity) AS mean, stddev_pop(l_quantity) AS std, count(*) AS total FROM lineitem),
c AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS x, count(*) AS n FROM lineitem GROUP BY 1)
SELECT x, n, {r("n / CAST(total AS DOUBLE)")} AS observed,
       {r("exp(-(x - mean) * (x - mean) / (2 * std * std)) / (std * sqrt(2 * pi()))")} AS normal_density,
       {r("mean")} AS mean, {r("std")} AS std FROM c, s
""")
def normal_fit(t):
    return publish(distributions.normal_fit(t.lineitem, "l_quantity"))


@query(f"""
WITH RECURSIVE b AS (
  SELECT avg(value) AS mean, stddev_pop(value) AS std, min(value) AS lo, max(value) AS hi, avg(value * value) AS msq,
         avg(ln(value)) AS lm, stddev_pop(ln(value)) AS ls, count(*) AS total FROM events),
{gamma_newton_sql("b", "newton", "total")},
p AS (SELECT *, (SELECT k FROM newton WHERE i = 12) AS gk, (hi - lo) / 60 AS w, mean - lo AS es, std / sqrt(2) AS la, std * sqrt(3) / pi() AS lg,
             std * sqrt(6) / pi() AS gu, msq / 2 AS ry FROM b),
h AS (SELECT least(floor((value - lo) / w), 59) AS bin, count(*) AS n FROM events, p GROUP BY 1),
g AS (SELECT lo + (i + 0.5) * w AS x, coalesce(n, 0) / (total * w) AS y, p.*
      FROM range(60) AS s(i) LEFT JOIN h ON i = bin CROSS JOIN p),
e AS (
  SELECT 'normal' AS family, sum(power(y - exp(-power((x - mean) / std, 2) / 2) / (std * sqrt(2 * pi())), 2)) AS sse FROM g
  UNION ALL SELECT 'gamma', sum(power(y - exp((gk - 1) * ln(x) - x * gk / mean - gk * ln(mean / gk) - lgamma(gk)), 2)) FROM g
  UNION ALL SELECT 'exponential', sum(power(y - exp(-(x - lo) / es) / es, 2)) FROM g
  UNION ALL SELECT 'uniform', sum(power(y - 1 / (hi - lo), 2)) FROM g
  UNION ALL SELECT 'laplace', sum(power(y - exp(-abs(x - mean) / la) / (2 * la), 2)) FROM g
  UNION ALL SELECT 'logistic', sum(power(y - exp(-(x - mean) / lg) / (lg * power(1 + exp(-(x - mean) / lg), 2)), 2)) FROM g
  UNION ALL SELECT 'gumbel', sum(power(y - exp(-((x - mean) / gu + 0.5772156649015329) - exp(-((x - mean) / gu + 0.5772156649015329))) / gu, 2)) FROM g
  UNION ALL SELECT 'rayleigh', sum(power(y - x / ry * exp(-x * x / (2 * ry)), 2)) FROM g
  UNION ALL SELECT 'lognormal', sum(power(y - exp(-power((ln(x) - lm) / ls, 2) / 2) / (x * ls * sqrt(2 * pi())), 2)) FROM g)
SELECT family, {r("sse", 9)} AS sse, CAST(rank() OVER (ORDER BY sse) AS BIGINT) AS rank FROM e
""")
def best_fit(t):
    return publish(distributions.best_fit(t.events, "value", 60), 9)


@query(f"SELECT {r('avg(ln(l_quantity))')} AS from_pmf, {r('avg(ln(l_quantity))')} AS direct FROM lineitem")
def lotus(t):
    return publish(distributions.lotus(t.lineitem, "l_quantity", F.ln))


@query(f"""
SELECT o_orderkey, count(*) OVER w AS trials,
       {r("sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w / CAST(count(*) OVER w AS DOUBLE)")} AS proportion
FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
""")
def running_proportion(t):
    few = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    return publish(
        distributions.running_proportion(
            few,
            ["o_orderdate", "o_orderkey"],
            F.col("o_orderstatus") == "F",
        ).select("o_orderkey", "trials", "proportion")
    )


@query(f"""
SELECT o_custkey, o_orderkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w / CAST(count(*) OVER w AS DOUBLE) >= 0.5 AS mostly_finished,
       count(*) OVER w AS orders_to_go
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC ROWS UNBOUNDED PRECEDING)
""")
def running_share_per_client(t):
    few = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    summed = ordered.running_totals(
        few,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        {
            "hits": F.expr("CASE WHEN o_orderstatus = 'F' THEN 1L ELSE 0L END"),
            "orders_to_go": F.lit(1).cast("long"),
        },
        descending=True,
    )
    return summed.selectExpr(
        "o_custkey", "o_orderkey", "double(hits) / orders_to_go >= 0.5D AS mostly_finished", "orders_to_go"
    )


_P_SQL = """est AS (SELECT o_orderpriority, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS p
  FROM orders GROUP BY 1)"""


def _estimates(t):
    return distributions.bernoulli(t.orders, F.expr("o_orderstatus = 'F'"), ["o_orderpriority"])


@query(f"""
WITH {_P_SQL} SELECT o_orderpriority, n, {r("p")} AS p, {r("1 - p")} AS q FROM est
""")
def bernoulli_estimate(t):
    return publish(_estimates(t))


@query(f"""
WITH {_P_SQL},
g AS (SELECT o_orderpriority, k, exp(lgamma(21) - lgamma(k + 1) - lgamma(21 - k) + k * ln(p) + (20 - k) * ln(1 - p)) AS pmf
      FROM est, range(21) AS s(k))
SELECT o_orderpriority, k AS x, {r("pmf", 9)} AS pmf, {r("sum(pmf) OVER w", 9)} AS cdf, {r("1 + pmf - sum(pmf) OVER w", 9)} AS tail
FROM g WINDOW w AS (PARTITION BY o_orderpriority ORDER BY k)
""")
def binomial_pmf(t):
    params = _estimates(t).drop("n").withColumn("trials", F.lit(20))
    out = distributions.binomial(params, ["o_orderpriority"], "trials", "p")
    return publish(out.select("o_orderpriority", "x", "pmf", "cdf", "tail"), 9)


@query(f"""
WITH c AS (SELECT count(*) AS big, CAST(sum(toxic) AS BIGINT) AS good FROM labels),
g AS (SELECT k, exp(lgamma(good + 1) - lgamma(k + 1) - lgamma(good - k + 1) + lgamma(big - good + 1) - lgamma(26 - k)
             - lgamma(big - good - 25 + k + 1) - lgamma(big + 1) + lgamma(26) + lgamma(big - 24)) AS pmf
      FROM c, range(26) AS s(k) WHERE k <= good AND 25 - k <= big - good)
SELECT k AS x, {r("pmf", 9)} AS pmf, {r("sum(pmf) OVER (ORDER BY k)", 9)} AS cdf,
       {r("1 + pmf - sum(pmf) OVER (ORDER BY k)", 9)} AS tail FROM g
""")
def hypergeometric_pmf(t):
    params = t.labels.agg(F.count(F.lit(1)).alias("big"), F.sum("toxic").alias("good"))
    params = params.withColumn("draws", F.lit(25))
    out = distributions.hypergeometric(params, ["big"], "big", "good", "draws")
    return publish(out.select("x", "pmf", "cdf", "tail"), 9)


@query(f"""
WITH {_P_SQL}
SELECT o_orderpriority, k AS x, {r("p * power(1 - p, k - 1)", 9)} AS pmf, {r("1 - power(1 - p, k)", 9)} AS cdf,
       {r("power(1 - p, k)", 9)} AS survival FROM est, range(1, 31) AS s(k)
""")
def geometric_pmf(t):
    out = distributions.geometric(_estimates(t), ["o_orderpriority"], "p", 30)
    return publish(out.select("o_orderpriority", "x", "pmf", "cdf", "survival"), 9)


@query(f"""
WITH c AS (SELECT date_diff('hour', TIMESTAMP '1970-01-01', ts) AS slot, count(*) AS n FROM events GROUP BY 1),
g AS (SELECT unnest(range(min(slot), max(slot) + 1)) AS slot FROM c),
f AS (SELECT coalesce(n, 0) AS x FROM g LEFT JOIN c USING (slot)),
s AS (SELECT avg(x) AS rate, var_samp(x) / avg(x) AS dispersion, count(*) AS total FROM f)
SELECT x, count(*) AS intervals, {r("count(*) / CAST(max(total) AS DOUBLE)")} AS observed,
       {r("exp(x * ln(max(rate)) - max(rate) - lgamma(x + 1))")} AS poisson, {r("max(rate)")} AS rate,
       {r("max(dispersion)")} AS dispersion FROM f, s GROUP BY x
""")
def poisson_hourly_events(t):
    return publish(distributions.poisson_fit(distributions.interval_counts(t.events, "ts", "hour")))


@query(f"""
WITH o AS (SELECT l_linenumber, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS k FROM lineitem GROUP BY 1),
c AS (SELECT l_linenumber, avg(l_tax) * 8 AS rate FROM lineitem GROUP BY 1
      UNION ALL SELECT l_linenumber, avg(l_discount) * 7 FROM lineitem GROUP BY 1)
SELECT l_linenumber, n, CAST(k AS BIGINT) AS k, {r("rate")} AS rate,
  {r("lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(rate) + (n - k) * ln(1 - rate)", 4)} AS log_likelihood
FROM o JOIN c USING (l_linenumber)
""")
def claims_likelihood(t):
    observed = t.lineitem.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.expr("l_returnflag = 'R'")).alias("k")
    )
    tax = t.lineitem.groupBy("l_linenumber").agg(F.expr("avg(l_tax) * 8").alias("rate"))
    discount = t.lineitem.groupBy("l_linenumber").agg(F.expr("avg(l_discount) * 7").alias("rate"))
    out = distributions.claims_likelihood(
        observed, "k", "n", tax.unionByName(discount), "rate", "l_linenumber"
    )
    return publish(out.select("l_linenumber", "n", "k", "rate", "log_likelihood"), log_likelihood=4)


_H60 = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"


@query(f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'R' AS hit,
    {_H60.format("concat_ws(':', '11', l_orderkey, l_linenumber, l_partkey, l_suppkey)")} AS h FROM lineitem),
s AS (SELECT i AS replicate, {_H60.format("concat_ws(':', '11', 'replicate', i)")} AS s FROM range(1, 101) AS g(i)),
o AS (SELECT replicate, hit, row_number() OVER (PARTITION BY replicate ORDER BY xor(h, s), l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place
      FROM x, s)
SELECT CAST(replicate AS INTEGER) AS replicate, count(*) AS drawn, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS successes
FROM o WHERE place <= 30 GROUP BY 1
""")
def sampling_distribution(t):
    return distributions.sampling_distribution(
        t.lineitem,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        F.expr("l_returnflag = 'R'"),
        n=30,
        replicates=100,
        seed=11,
    )


# --- survival ----------------------------------------------------------------

_EVENTS_SQL = f"""{v.LIFETIMES_SQL},
ev AS (SELECT segment, lifetime_weeks AS t, sum(CASE WHEN has_died THEN 1 ELSE 0 END) AS observed,
              sum(CASE WHEN has_died THEN 0 ELSE 1 END) AS censored FROM lifetimes GROUP BY 1, 2),
risk AS (SELECT *, sum(observed + censored) OVER (PARTITION BY segment ORDER BY t DESC) AS at_risk FROM ev),
km AS (SELECT *, CASE WHEN max(CASE WHEN observed = at_risk THEN 1 ELSE 0 END) OVER w = 1 THEN 0
                      ELSE exp(coalesce(sum(CASE WHEN observed < at_risk THEN ln(1 - observed / at_risk) END) OVER w, 0)) END AS survival
       FROM risk WINDOW w AS (PARTITION BY segment ORDER BY t)),
mle AS (SELECT segment, count(*) AS subjects, sum(CASE WHEN has_died THEN 1 ELSE 0 END) AS events, sum(lifetime_weeks) AS exposure,
               sum(CASE WHEN has_died THEN 1 ELSE 0 END) / CAST(sum(lifetime_weeks) AS DOUBLE) AS p_hat
        FROM lifetimes WHERE lifetime_weeks > 0 GROUP BY 1)"""


def _died():
    return F.col("has_died")


@query(f"""
WITH {_EVENTS_SQL}
SELECT segment, t, CAST(observed AS BIGINT) AS observed, CAST(censored AS BIGINT) AS censored,
       CAST(at_risk AS BIGINT) AS at_risk, {r("survival")} AS survival FROM km
""")
def km_curve(t):
    return publish(
        survival.kaplan_meier(v.lifetimes(t), "lifetime_weeks", _died(), ["segment"])
    )


@query(f"""
WITH {_EVENTS_SQL}
SELECT segment, min(CASE WHEN survival <= 0.5 + 1e-12 THEN t END) AS median_t FROM km GROUP BY 1
""")
def km_median(t):
    curve = survival.kaplan_meier(v.lifetimes(t), "lifetime_weeks", _died(), ["segment"])
    return survival.median_survival(curve, ["segment"])


@query(f"""
WITH {_EVENTS_SQL}
SELECT segment, subjects, CAST(events AS BIGINT) AS events, CAST(exposure AS BIGINT) AS exposure, {r("p_hat", 9)} AS p_hat,
       {r("1 / nullif(p_hat, 0)")} AS mean_lifetime,
       CASE WHEN p_hat > 0 AND p_hat < 1 THEN CAST(ceil(-ln(2) / ln(1 - p_hat)) AS BIGINT) END AS median_lifetime FROM mle
""")
def geometric_mle(t):
    return publish(
        survival.geometric_mle(v.lifetimes(t), "lifetime_weeks", _died(), ["segment"]), p_hat=9
    )


@query(f"""
WITH {_EVENTS_SQL}
SELECT segment, t, {r("survival")} AS survival, {r("power(1 - p_hat, t)")} AS fitted,
       {r("survival - power(1 - p_hat, t)")} AS gap FROM km LEFT JOIN mle USING (segment)
""")
def fitted_vs_km(t):
    return publish(
        survival.fitted_curve(v.lifetimes(t), "lifetime_weeks", _died(), ["segment"])
    )


@query(f"""
WITH {v.LIFETIMES_SQL}, steps AS (SELECT unnest([0, 52, 104, 156, 208, 260]) AS s),
g AS (SELECT a.s AS s, b.s AS t FROM steps a, steps b)
SELECT s, t, {r("avg(CASE WHEN lifetime_weeks >= t THEN CASE WHEN lifetime_weeks >= s + t THEN 1.0 ELSE 0.0 END END)")} AS given_survived_t,
       {r("avg(CASE WHEN lifetime_weeks >= s THEN 1.0 ELSE 0.0 END)")} AS from_start,
       {r("avg(CASE WHEN lifetime_weeks >= t THEN CASE WHEN lifetime_weeks >= s + t THEN 1.0 ELSE 0.0 END END) - avg(CASE WHEN lifetime_weeks >= s THEN 1.0 ELSE 0.0 END)")} AS difference
FROM lifetimes, g GROUP BY 1, 2
""")
def memoryless(t):
    return publish(
        survival.memoryless(v.lifetimes(t), "lifetime_weeks", [0, 52, 104, 156, 208, 260])
    )
