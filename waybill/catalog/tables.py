"""Registered profiles, frame operations, expressions and contingency tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill import functions as fn
from waybill.catalog import views as v
from waybill.catalog.registry import publish, query, r, upper_gamma_sql
from waybill.operators import contingency, frames, quality
from waybill.sources import (
    calendar_spanning,
    from_rows,
    head_rows,
    lower_names,
    register_views,
    rename_all,
    run_sql,
    sample_rows,
    tail_rows,
)


def _iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def _gappy(t):
    """Orders whose price is unknown while pending."""
    return t.orders.selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price",
    )


_GAPPY_SQL = """gappy AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
  FROM orders)"""


# --- sources -----------------------------------------------------------------


@query("""
SELECT o_orderpriority AS mode, count(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1
""")
def sql_text_with_dates(t):
    register_views(t.spark, t.directory, ["orders"])
    text = """
        SELECT o_orderpriority AS MODE, count(*) AS N FROM orders
        WHERE o_orderdate >= to_timestamp_ntz(:start) AND o_orderdate < to_timestamp_ntz(:end)
        GROUP BY 1
    """
    return run_sql(t.spark, text, start="1997-01-01", end="1998-01-01")


@query("""
SELECT o_orderkey AS shipment, o_totalprice AS amount, 'first' AS side
FROM (SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 6)
UNION ALL
SELECT o_orderkey, o_totalprice, 'last'
FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10)
""")
def head_and_tail(t):
    small = rename_all(t.orders.select("o_orderkey", "o_totalprice"), ["SHIPMENT", "AMOUNT"])
    small = lower_names(small)
    order = ["amount", "shipment"]
    first = head_rows(small, order, 6).withColumn("side", F.lit("first"))
    return first.unionByName(tail_rows(small, order, 10).withColumn("side", F.lit("last")))


@query()
def random_preview(t):
    return sample_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 25, seed=7)


@query(f"""
WITH span AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders),
months AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM span),
counts AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT {_iso("m")} AS month, {_iso("last_day(m)")} AS month_end, {_iso("date_trunc('quarter', m)")} AS quarter,
       coalesce(n, 0) AS pending FROM months LEFT JOIN counts USING (m)
""")
def month_calendar(t):
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    dated = t.orders.select(month.alias("month"), "o_orderstatus")
    months = calendar_spanning(dated, "month", "1 month", "month")
    pending = dated.where("o_orderstatus = 'P'").groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    return publish(
        months.join(pending, "month", "left").select(
            "month",
            fn.month_end(F.year("month"), F.month("month")).alias("month_end"),
            fn.quarter_start("month").alias("quarter"),
            F.coalesce("n", F.lit(0)).alias("pending"),
        )
    )


# --- expressions -------------------------------------------------------------


@query(f"""
WITH e AS (SELECT event_id, ts AS a, ts + to_minutes(event_id % 90000) AS b FROM events)
SELECT event_id, date_diff('second', a, b) AS seconds, date_diff('minute', a, b) AS minutes,
       date_diff('hour', a, b) AS hours, date_diff('day', a, b) AS days, date_diff('day', date_trunc('week', a), date_trunc('week', b)) // 7 AS weeks,
       date_diff('month', a, b) AS months, date_diff('quarter', a, b) AS quarters, date_diff('year', a, b) AS years,
       {_iso("CAST(a AS DATE) + CAST(1 - dayofweek(a) AS INTEGER)")} AS week_label
FROM e
""")
def unit_boundaries(t):
    later = F.expr("ts + make_dt_interval(0, 0, int(event_id % 90000))")
    e = t.events.select("event_id", F.col("ts").alias("a"), later.alias("b"))
    units = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")
    return publish(
        e.select(
            "event_id",
            *[fn.boundary_diff(u, "a", "b").alias(f"{u}s") for u in units],
            fn.monday_bucket("a").alias("week_label"),
        )
    )


@query(f"""
SELECT p_partkey, replace(p_name, ' ', '_') AS slug, p_retailprice AS parsed,
       {r("p_retailprice / nullif(p_size - 1, 0)")} AS density, {r("p_retailprice / 1000")} AS p,
       {r("ln((p_retailprice / 1000) / (1 - p_retailprice / 1000))")} AS logit,
       {r("1 / (1 + exp(-(p_size / 10.0)))")} AS logistic, {r("lgamma(p_size + 1)")} AS log_factorial,
       {r("lgamma(51) - lgamma(p_size + 1) - lgamma(51 - p_size)")} AS log_choose,
       upper(p_type) = 'ECONOMY' AS economy, CASE WHEN p_size % 2 = 0 THEN true ELSE false END AS flag
FROM part
""")
def scalar_functions(t):
    text = F.expr("concat('US$', format_number(p_retailprice, 2))")
    flag = F.expr("CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'FALSE' END")
    p = F.col("p_retailprice") / 1000
    return publish(
        t.part.select(
            "p_partkey",
            fn.slug(fn.strip_quotes(F.concat(F.lit('"'), "p_name", F.lit('"')))).alias("slug"),
            fn.parse_money(text).alias("parsed"),
            fn.density(F.col("p_retailprice"), F.col("p_size") - 1).alias("density"),
            p.alias("p"),
            fn.logit(p).alias("logit"),
            fn.logistic(F.col("p_size") / 10).alias("logistic"),
            fn.log_factorial("p_size").alias("log_factorial"),
            fn.log_choose(F.lit(50), F.col("p_size")).alias("log_choose"),
            fn.same_text("p_type", F.lit("economy")).alias("economy"),
            fn.truthy(flag).alias("flag"),
        )
    )


# --- frames ------------------------------------------------------------------


@query("""
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
JOIN (SELECT o_orderpriority, max(o_totalprice) AS top FROM orders GROUP BY 1) USING (o_orderpriority)
WHERE o_totalprice = top
""")
def largest_orders(t):
    few = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return frames.argmax_rows(few, "o_totalprice", ["o_orderpriority"])


@query("SELECT event_id, value FROM events WHERE value = (SELECT max(value) FROM events)")
def largest_event(t):
    return frames.argmax_rows(t.events.select("event_id", "value"), "value")


@query(f"""
SELECT o_custkey, o_orderkey, {_iso("o_orderdate")} AS o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def first_order_per_customer(t):
    few = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    once = frames.dedup_first(few, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return publish(once.withColumn("o_orderdate", F.col("o_orderdate").cast("date")), 2)


@query(f"""
SELECT o_orderkey, {r("max(o_totalprice) OVER (PARTITION BY o_custkey)", 2)} AS client_max,
       {r("min(o_totalprice) OVER (PARTITION BY o_custkey)", 2)} AS client_min FROM orders
""")
def client_extremes_per_order(t):
    few = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    values = {"client_max": F.max("o_totalprice"), "client_min": F.min("o_totalprice")}
    return publish(
        frames.group_values(few, ["o_custkey"], values, ["o_orderkey"]).select(
            "o_orderkey", "client_max", "client_min"
        ),
        2,
    )


@query(f"""
WITH {_GAPPY_SQL}, m AS (SELECT o_orderpriority, median(price) AS mid FROM gappy GROUP BY 1)
SELECT o_orderkey, {r("coalesce(price, mid)", 3)} AS imputed FROM gappy LEFT JOIN m USING (o_orderpriority)
""")
def impute_missing_prices(t):
    filled = frames.impute_group_median(
        _gappy(t), "o_orderpriority", "price", "imputed", spread_by=["o_orderkey"]
    )
    return publish(filled.select("o_orderkey", "imputed"), 3)


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event_type_error,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type_purchase,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS event_type_signup,
       CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view FROM events
""")
def dummies(t):
    few = t.events.select("event_id", "event_type")
    levels = frames.levels_of(few, "event_type")
    return frames.dummies(few, "event_type", levels, levels[0] if levels else None).drop("event_type")


@query("""
SELECT l_returnflag, variable, count(*) AS n, round(max(value), 6) + 0.0 AS top FROM (
  SELECT l_returnflag, 'l_tax' AS variable, l_tax AS value FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem) GROUP BY 1, 2
""")
def unpivot_tax_discount(t):
    tall = frames.melt(t.lineitem, ["l_returnflag"], ["l_tax", "l_discount"])
    return publish(
        tall.groupBy("l_returnflag", "variable").agg(
            F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
        )
    )


@query("""
SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 END) AS BIGINT) AS F,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 END) AS BIGINT) AS O FROM lineitem GROUP BY 1
UNION ALL
SELECT 'Total', CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 END) AS BIGINT),
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 END) AS BIGINT) FROM lineitem
""")
def wide_crosstab_with_total(t):
    counts = contingency.pair_counts(t.lineitem, "l_returnflag", "l_linestatus")
    wide = frames.unstack(counts, ["l_returnflag"], "l_linestatus", None, F.sum("n"))
    return frames.with_total_row(wide, "l_returnflag")


# --- quality -----------------------------------------------------------------


@query(f"""
WITH {_GAPPY_SQL}
SELECT column_name, count(*) AS n_rows, {r("avg(CASE WHEN missing THEN 1.0 ELSE 0.0 END)")} AS null_fraction,
       bool_or(missing) AS has_nulls
FROM (SELECT 'o_orderkey' AS column_name, o_orderkey IS NULL AS missing FROM gappy
      UNION ALL SELECT 'o_custkey', o_custkey IS NULL FROM gappy
      UNION ALL SELECT 'o_orderpriority', o_orderpriority IS NULL FROM gappy
      UNION ALL SELECT 'price', price IS NULL FROM gappy) GROUP BY 1
""")
def null_profile(t):
    return publish(quality.null_profile(_gappy(t)))


@query("""
SELECT 'l_partkey' AS column_name, count(DISTINCT l_partkey) AS n_distinct FROM lineitem
UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem
""")
def distinct_profile(t):
    return quality.distinct_profile(t.lineitem, ["l_partkey", "l_quantity", "l_returnflag"])


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS count, {r(f"avg({column})")} AS mean,
  {r(f"stddev_samp({column})")} AS std, {r(f"min({column})")} AS min, {r(f"quantile_cont({column}, 0.25)")} AS q25,
  {r(f"quantile_cont({column}, 0.5)")} AS q50, {r(f"quantile_cont({column}, 0.75)")} AS q75,
  {r(f"max({column})")} AS max FROM lineitem"""


@query(" UNION ALL ".join(_describe_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def describe_lineitem(t):
    return publish(quality.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2")
def grain_check(t):
    return quality.grain(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"""
SELECT o_orderpriority AS value, count(*) AS n, {r("count(*) / CAST((SELECT count(*) FROM orders) AS DOUBLE)")} AS share
FROM orders GROUP BY 1
""")
def value_frequency(t):
    return publish(quality.frequencies(t.orders, "o_orderpriority"))


@query(f"""
SELECT count(*) AS n_keys, {r("avg(CASE WHEN n > 10 THEN 1.0 ELSE 0.0 END)")} AS share_repeated
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
""")
def frequent_customers(t):
    return publish(quality.repeated_share(t.orders, "o_custkey", 10))


@query(f"""
SELECT l_returnflag, l_linestatus, {r("quantile_cont(l_extendedprice, 0.25)")} AS q25,
       {r("quantile_cont(l_extendedprice, 0.5)")} AS q50, {r("quantile_cont(l_extendedprice, 0.75)")} AS q75
FROM lineitem GROUP BY 1, 2
""")
def price_quantiles_by_group(t):
    return publish(
        quality.group_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    )


def _histogram_sql(table: str, column: str, bins: int, lo: str, hi: str) -> str:
    return f"""
WITH b AS (SELECT {lo} AS lo, {hi} AS hi, ({hi} - {lo}) / {bins} AS w FROM {table}),
h AS (SELECT CAST(least(floor(({column} - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
      FROM {table}, b WHERE {column} BETWEEN lo AND hi GROUP BY 1),
g AS (SELECT CAST(x AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range({bins}) AS s(x) LEFT JOIN h ON x = bin)
SELECT bin, {r("lo + bin * w")} AS left_edge, {r("lo + (bin + 1) * w")} AS right_edge,
       {r("lo + (bin + 0.5) * w")} AS midpoint, n, {r("n / (sum(n) OVER () * w)", 9)} AS density,
       {r("sum(n) OVER (ORDER BY bin) / sum(n) OVER ()")} AS cumulative
FROM g, b"""


@query(_histogram_sql("lineitem", "l_extendedprice", 50, "min(l_extendedprice)", "max(l_extendedprice)"))
def histogram_price(t):
    return publish(quality.histogram(t.lineitem, "l_extendedprice", 50), density=9)


@query(_histogram_sql("events", "value", 40, "min(0.0::DOUBLE)", "max(200.0::DOUBLE)"))
def histogram_bounded(t):
    return publish(quality.histogram(t.events, "value", 40, (0.0, 200.0)), density=9)


@query(f"""
SELECT o_orderpriority, count(*) AS n, {r("avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)")} AS finished_rate
FROM orders GROUP BY 1
""")
def finished_rate(t):
    return publish(
        quality.rate(t.orders, ["o_orderpriority"], F.col("o_orderstatus") == "F", "finished_rate")
    )


# --- contingency -------------------------------------------------------------


def _brands(t):
    return t.part.select("p_brand", "p_size")


_CELLS_SQL = """cells AS (
  SELECT p_brand, p_size, count(p_partkey) AS n
  FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN (SELECT DISTINCT p_size FROM part)
  LEFT JOIN part USING (p_brand, p_size) GROUP BY 1, 2)"""


@query(f"WITH {_CELLS_SQL} SELECT p_brand, p_size, n FROM cells")
def crosstab_counts(t):
    return contingency.crosstab(_brands(t), "p_brand", "p_size")


@query("""
SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, coalesce(o_orderstatus, 'All') AS o_orderstatus, count(*) AS n
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)
""")
def crosstab_margins(t):
    return contingency.crosstab(t.orders, "o_orderpriority", "o_orderstatus", margins=True)


@query(f"""
WITH {_CELLS_SQL}
SELECT p_brand, p_size, n, {r("n / sum(n) OVER ()")} AS joint, {r("n / sum(n) OVER (PARTITION BY p_brand)")} AS given_row,
       {r("n / sum(n) OVER (PARTITION BY p_size)")} AS given_col,
       {r("sum(n) OVER (PARTITION BY p_brand) / sum(n) OVER ()")} AS row_marginal,
       {r("sum(n) OVER (PARTITION BY p_size) / sum(n) OVER ()")} AS col_marginal FROM cells
""")
def conditional_freq(t):
    return publish(contingency.conditional(_brands(t), "p_brand", "p_size"))


_E = "CAST(sum(n) OVER (PARTITION BY p_brand) AS DOUBLE) * sum(n) OVER (PARTITION BY p_size) / sum(n) OVER ()"


@query(f"""
WITH {_CELLS_SQL}
SELECT p_brand, p_size, n AS observed, {r(_E)} AS expected, {r(f"n - {_E}")} AS residual FROM cells
""")
def expected_counts(t):
    return publish(contingency.expected(_brands(t), "p_brand", "p_size"))


_MODE_SQL = f"""WITH {v.REGIONS_SQL},
base AS (SELECT o_orderpriority AS mode, r_name AS tradelane FROM orders JOIN client_regions ON o_custkey = c_custkey),
cells AS (SELECT mode, tradelane, count(*) AS n FROM base GROUP BY 1, 2),
e AS (SELECT *, CAST(sum(n) OVER (PARTITION BY mode) AS DOUBLE) * sum(n) OVER (PARTITION BY tradelane) / sum(n) OVER () AS ex FROM cells),
s AS (SELECT sum((n - ex) * (n - ex) / ex) AS chi2, CAST(sum(n) AS BIGINT) AS n,
             (count(DISTINCT mode) - 1) * (count(DISTINCT tradelane) - 1) AS dof FROM e)"""


def _mode_tradelane(t):
    # Counted per client first, so that the join meets counts, not orders.
    per_client = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    regions = v.client_regions(t).select("c_custkey", F.col("r_name").alias("tradelane"))
    return per_client.join(regions, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderpriority").alias("mode"), "tradelane", "n"
    )


@query(f"""
{_MODE_SQL}
SELECT {r("chi2")} AS chi2, dof, n,
       {r("(SELECT sum(exp(-chi2 / 2 + k * ln(chi2 / 2) - lgamma(k + 1))) FROM range(8) AS x(k))")} AS p_value FROM s
""")
def chi2_mode_tradelane(t):
    return publish(
        contingency.chi2_independence(_mode_tradelane(t), "mode", "tradelane", weight=F.col("n"))
    )


@query(f"""
WITH cells AS (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2),
e AS (SELECT *, CAST(sum(n) OVER (PARTITION BY quality) AS DOUBLE) * sum(n) OVER (PARTITION BY toxic) / sum(n) OVER () AS ex FROM cells)
SELECT {r("chi2")} AS chi2, CAST(1 AS BIGINT) AS dof, n, {r(upper_gamma_sql("0.5", "(chi2 / 2)"))} AS p_value
FROM (SELECT sum(power(abs(n - ex) - least(0.5, abs(n - ex)), 2) / ex) AS chi2, CAST(sum(n) AS BIGINT) AS n FROM e)
""")
def chi2_yates(t):
    test = contingency.chi2_independence(t.labels, "quality", "toxic", yates=True)
    return publish(test)


@query(f"""
SELECT count(*) AS n, {r("avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)")} AS direct,
       {r("avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)")} AS by_parts FROM lineitem
""")
def total_probability(t):
    return publish(
        contingency.total_probability(t.lineitem, F.col("l_returnflag") == "R", "l_linenumber")
    )


_A, _B = "l_quantity > 25", "l_discount >= 0.05"


def _share(condition: str, among: str = "true") -> str:
    return r(
        f"sum(CASE WHEN ({condition}) AND ({among}) THEN 1 ELSE 0 END) / "
        f"CAST(sum(CASE WHEN {among} THEN 1 ELSE 0 END) AS DOUBLE)"
    )


@query(f"""
SELECT count(*) AS n, {_share(_A)} AS p_a, {_share(_B)} AS p_b, {_share(f"NOT ({_A})")} AS p_not_a,
       {_share(f"{_A} AND {_B}")} AS p_a_and_b, {_share(f"{_A} OR {_B}")} AS p_a_or_b,
       {_share(f"{_A} OR {_B}")} AS p_a_or_b_by_sum, {_share(_A, _B)} AS p_a_given_b, {_share(_B, _A)} AS p_b_given_a
FROM lineitem
""")
def set_event_probability(t):
    return publish(contingency.set_probabilities(t.lineitem, F.expr(_A), F.expr(_B)))


@query(f"""
SELECT count(CASE WHEN l_linestatus = 'O' OR l_tax > 0.04 THEN 1 END) AS n_given,
       {r("avg(CASE WHEN l_linestatus = 'O' OR l_tax > 0.04 THEN CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END END)")} AS probability
FROM lineitem
""")
def prob_given(t):
    given = F.expr("l_linestatus = 'O' OR l_tax > 0.04D")
    return publish(contingency.prob_given(t.lineitem, F.expr("l_returnflag = 'R'"), given))


@query(f"""
SELECT m.label, count(*) AS n FROM orders LEFT JOIN (VALUES ('1-URGENT', 'fast'), ('2-HIGH', 'fast'), ('5-LOW', 'slow')) AS m(p, label)
ON o_orderpriority = m.p GROUP BY 1
""")
def lookup_merge(t):
    labels = from_rows(
        t.spark,
        [("1-URGENT", "fast"), ("2-HIGH", "fast"), ("5-LOW", "slow")],
        "o_orderpriority string, label string",
    )
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(labels, "o_orderpriority", "left").groupBy("label").agg(F.sum("n").alias("n"))
