"""Registered Bayes, odds and Simpson queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog import views as v
from waybill.catalog.registry import publish, query, r, two_sided_sql
from waybill.operators import bayes, simpson


@query(f"""
WITH p AS (
  SELECT count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS prior,
         avg(CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END END) AS eh,
         avg(CASE WHEN l_returnflag <> 'R' THEN CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END END) AS enh,
         avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) AS e,
         avg(CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END END) AS direct
  FROM lineitem WHERE l_quantity > 10)
SELECT n, {r("prior")} AS prior, {r("eh")} AS p_e_given_h, {r("enh")} AS p_e_given_not_h, {r("e")} AS p_e,
       {r("direct")} AS direct, {r("direct")} AS posterior FROM p
""")
def posterior_from_data(t):
    return publish(
        bayes.posterior_from_data(
            t.lineitem,
            F.expr("l_returnflag = 'R'"),
            F.expr("l_linestatus = 'F'"),
            F.expr("l_quantity > 10"),
        )
    )


def _priors(t):
    """Share of finished orders per client as prior; likelihoods from its priorities."""
    return t.orders.groupBy("o_custkey").agg(
        F.expr("avg(CASE WHEN o_orderstatus = 'F' THEN 1.0D ELSE 0.0D END)").alias("prior"),
        F.expr(
            "avg(CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0D ELSE 0.0D END END)"
        ).alias("p_e_h"),
        F.expr(
            "avg(CASE WHEN o_orderstatus <> 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0D ELSE 0.0D END END)"
        ).alias("p_e_not_h"),
    )


_PRIORS_SQL = """priors AS (
  SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS prior,
         avg(CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END END) AS eh,
         avg(CASE WHEN o_orderstatus <> 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END END) AS enh
  FROM orders GROUP BY 1),
grid AS (SELECT *, eh * prior / nullif(eh * prior + enh * (1 - prior), 0) AS posterior FROM priors)"""


@query(f"""
WITH {_PRIORS_SQL}
SELECT o_custkey, {r("prior")} AS prior, {r("eh")} AS p_e_h, {r("enh")} AS p_e_not_h, {r("posterior")} AS posterior,
       {r("posterior / nullif(1 - posterior, 0)")} AS posterior_odds FROM grid
""")
def posterior_grid(t):
    return publish(bayes.posterior_grid(_priors(t), "prior", "p_e_h", "p_e_not_h"))


@query(f"""
WITH {_PRIORS_SQL}
SELECT CAST(floor(eh * 10) AS BIGINT) AS likelihood_level, {r("max(CASE WHEN posterior < 0.3 THEN prior END)")} AS largest_prior FROM grid GROUP BY 1
""")
def largest_prior_below(t):
    grid = bayes.posterior_grid(_priors(t), "prior", "p_e_h", "p_e_not_h")
    grid = grid.withColumn("likelihood_level", F.floor(F.col("p_e_h") * 10))
    return publish(bayes.largest_prior_below(grid, "prior", 0.3, ["likelihood_level"]))


_EVIDENCE_SQL = """per_line AS (
  SELECT l_suppkey, l_linenumber, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS k
  FROM lineitem GROUP BY 1, 2),
whole AS (SELECT CAST(sum(k) AS DOUBLE) / (sum(n) - sum(k)) AS odds FROM per_line),
evidence AS (SELECT l_suppkey, odds AS prior_odds, (k + 1.0) / (n - k + 1.0) / odds AS lr FROM per_line, whole)"""


@query(f"""
WITH {_EVIDENCE_SQL},
u AS (SELECT l_suppkey, count(*) AS pieces, max(prior_odds) AS prior_odds,
             max(prior_odds) * exp(sum(ln(lr))) AS posterior_odds FROM evidence GROUP BY 1)
SELECT l_suppkey, pieces, {r("prior_odds")} AS prior_odds, {r("posterior_odds")} AS posterior_odds,
       {r("posterior_odds / (1 + posterior_odds)")} AS posterior FROM u
""")
def update_odds(t):
    counts = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.expr("l_returnflag = 'R'")).alias("k")
    )
    odds = counts.agg(F.expr("double(sum(k)) / (sum(n) - sum(k))")).scalar()
    evidence = counts.withColumn("prior_odds", odds).withColumn(
        "ratio", F.expr("(k + 1.0D) / (n - k + 1.0D) / prior_odds")
    )
    return publish(bayes.update_odds(evidence, ["l_suppkey"], "prior_odds", "ratio"))


@query(f"""
WITH {v.REGIONS_SQL},
c AS (SELECT r_name, c_mktsegment, count(*) AS n FROM client_regions GROUP BY 1, 2)
SELECT r_name, c_mktsegment AS best_class, {r("n / CAST(total AS DOUBLE)")} AS probability FROM (
  SELECT *, sum(n) OVER (PARTITION BY r_name) AS total,
         row_number() OVER (PARTITION BY r_name ORDER BY n DESC, c_mktsegment DESC) AS rn FROM c) WHERE rn = 1
""")
def most_probable_class(t):
    return publish(bayes.most_probable_class(v.client_regions(t), "c_mktsegment", ["r_name"]))


_CELLS_SQL = """cells AS (
  SELECT l_linenumber, sum(CASE WHEN e AND o THEN 1 ELSE 0 END) AS a, sum(CASE WHEN e AND NOT o THEN 1 ELSE 0 END) AS b,
         sum(CASE WHEN NOT e AND o THEN 1 ELSE 0 END) AS c, sum(CASE WHEN NOT e AND NOT o THEN 1 ELSE 0 END) AS d
  FROM (SELECT l_linenumber, l_linestatus = 'O' AS e, l_returnflag = 'R' AS o FROM lineitem) GROUP BY 1)"""


def _cells(t):
    return bayes.two_by_two(
        t.lineitem,
        F.expr("l_linestatus = 'O'"),
        F.expr("l_returnflag = 'R'"),
        ["l_linenumber"],
    )


_ABCD = ", ".join(f"CAST({x} AS BIGINT) AS {x}" for x in "abcd")


@query(f"""
WITH {_CELLS_SQL}
SELECT l_linenumber, {_ABCD}, {r("a / b")} AS odds_exposed, {r("c / d")} AS odds_unexposed,
       {r("ln(a / b)")} AS log_odds_exposed, {r("ln(c / d)")} AS log_odds_unexposed,
       {r("(a / b) / (c / d)")} AS odds_ratio, {r("ln((a / b) / (c / d))")} AS log_odds_ratio,
       {r("(a / (a + b)) / (c / (c + d))")} AS relative_risk FROM cells
""")
def odds_table(t):
    return publish(bayes.odds_table(_cells(t)))


@query(f"""
WITH {_CELLS_SQL}
SELECT l_linenumber, {_ABCD}, {r("ln((a / b) / (c / d))")} AS log_odds_ratio,
       {r("sqrt(1.0 / a + 1.0 / b + 1.0 / c + 1.0 / d)")} AS std_error, {r("z")} AS z, {r(two_sided_sql("z"))} AS p_value
FROM (SELECT *, ln((a / b) / (c / d)) / sqrt(1.0 / a + 1.0 / b + 1.0 / c + 1.0 / d) AS z FROM cells)
""")
def wald_log_or(t):
    return publish(bayes.wald_log_odds_ratio(_cells(t)))


@query(f"""
WITH c AS (SELECT sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS a, sum(quality) AS draws,
                  sum(toxic) AS successes, count(*) AS population FROM labels),
terms AS (SELECT *, unnest(range(CAST(a AS BIGINT), CAST(least(draws, successes) AS BIGINT) + 1)) AS k FROM c)
SELECT CAST(a AS BIGINT) AS a, population, CAST(successes AS BIGINT) AS successes, CAST(draws AS BIGINT) AS draws,
  {r('''sum(CASE WHEN draws - k <= population - successes THEN exp(
    lgamma(successes + 1) - lgamma(k + 1) - lgamma(successes - k + 1)
    + lgamma(population - successes + 1) - lgamma(draws - k + 1) - lgamma(population - successes - draws + k + 1)
    - lgamma(population + 1) + lgamma(draws + 1) + lgamma(population - draws + 1)) ELSE 0 END)''')} AS tail
FROM terms GROUP BY a, population, successes, draws
""")
def hypergeom_tail(t):
    cells = bayes.two_by_two(t.labels, F.expr("quality = 1"), F.expr("toxic = 1"))
    return publish(bayes.hypergeom_tail(cells))


def _strata(t):
    """Returned and all lines by supplier region (stratum) and line number parity (group)."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("r_name").alias("stratum")
    )
    # Lines are counted per supplier first; the join meets one row per supplier and group.
    lines = t.lineitem.groupBy("l_suppkey", F.expr("l_linenumber % 4").alias("grp")).agg(
        F.count_if(F.expr("l_returnflag = 'R'")).alias("k"), F.count(F.lit(1)).alias("n")
    )
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    named = joined.withColumn("grp", F.concat(F.lit("g"), F.col("grp").cast("string")))
    return simpson.stratum_counts(named, "grp", "stratum", F.col("k"), F.col("n"))


_STRATA_SQL = """strata AS (
  SELECT 'g' || CAST(l_linenumber % 4 AS VARCHAR) AS grp, r_name AS stratum,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS num, count(*) AS den
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
overall AS (SELECT grp, sum(num) / CAST(sum(den) AS DOUBLE) AS rate FROM strata GROUP BY 1)"""


@query(f"""
WITH {_STRATA_SQL}
SELECT grp, stratum, num, den, {r("num / den")} AS rate, {r("den / sum(den) OVER (PARTITION BY grp)")} AS share,
       {r("rate")} AS total_rate FROM strata JOIN overall USING (grp)
""")
def simpson_standardised(t):
    return publish(simpson.standardised_rate(_strata(t), "grp", "stratum"))


@query(f"""
WITH {_STRATA_SQL},
gaps AS (SELECT s.grp, s.stratum, sign(s.num / s.den - b.num / b.den) AS sg FROM strata s
         JOIN strata b ON s.stratum = b.stratum AND b.grp = 'g0' WHERE s.grp <> 'g0'),
o AS (SELECT x.grp, x.rate - y.rate AS diff FROM overall x JOIN overall y ON y.grp = 'g0' WHERE x.grp <> 'g0')
SELECT o.grp, {r("max(diff)")} AS overall_difference, count(*) AS strata,
       min(sg) = max(sg) AND min(sg) * sign(max(diff)) = -1 AS reversed
FROM o JOIN gaps ON o.grp = gaps.grp GROUP BY o.grp
""")
def simpson_reversals(t):
    return publish(simpson.reversals(_strata(t), "grp", "stratum", "g0"))


@query(f"""
WITH {_STRATA_SQL}, mix AS (SELECT stratum, den AS w FROM strata WHERE grp = 'g1')
SELECT grp, {r("sum(num) / CAST(sum(den) AS DOUBLE)")} AS own_rate, {r("sum(num / den * w) / sum(w)")} AS reweighted_rate,
       {r("sum(w) / CAST((SELECT sum(w) FROM mix) AS DOUBLE)")} AS covered
FROM strata JOIN mix USING (stratum) GROUP BY 1
""")
def reweighted_rate(t):
    return publish(simpson.reweighted_rate(_strata(t), "grp", "stratum", "g1"))
