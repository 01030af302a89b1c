"""Registered time-series, attribution and distance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog import views as v
from waybill.catalog.registry import publish, query, r, two_sided_sql
from waybill.operators import attribution, frames, geo, timeseries
from waybill.sources.calendars import quarters


def _iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def _series(t):
    """Quarterly order value per segment, in millions."""
    return v.quarterly(t).withColumn("value", F.col("value") / 1e6)


_SERIES_SQL = f"""{v.SERIES_SQL.replace("series AS", "raw_series AS", 1)},
series AS (SELECT series_id, ts, value / 1000000.0::DOUBLE AS value FROM raw_series),
steps AS (SELECT *, lag(value) OVER w AS before, value - lag(value) OVER w AS diff, value / lag(value) OVER w - 1 AS pct
          FROM series WINDOW w AS (PARTITION BY series_id ORDER BY ts))"""
_DIFF_SQL = f"""{_SERIES_SQL},
d AS (SELECT series_id, ts, diff AS value, lag(diff) OVER (PARTITION BY series_id ORDER BY ts) AS x
      FROM steps WHERE diff IS NOT NULL),
fit AS (SELECT series_id, regr_count(value, x) AS n, regr_intercept(value, x) AS alpha, regr_slope(value, x) AS beta,
               regr_r2(value, x) AS r2 FROM d GROUP BY 1)"""


@query(f"WITH {_SERIES_SQL} SELECT series_id, {_iso('ts')} AS ts, {r('value')} AS value FROM series")
def quarterly_series(t):
    return publish(_series(t))


@query(f"""
WITH {_SERIES_SQL}
SELECT series_id, {_iso("ts")} AS ts, {r("value")} AS value, {r("diff")} AS diff, {r("pct")} AS pct_change FROM steps
WHERE ts BETWEEN DATE '1996-01-01' AND DATE '2000-10-01'
""")
def diff_pct(t):
    # The slice comes last, so that its first period still has a difference.
    return publish(
        timeseries.between_dates(timeseries.stationary(_series(t)), "1996-01-01", "2000-10-01")
    )


@query(f"""
WITH {_SERIES_SQL}
SELECT series_id, {_iso("ts")} AS ts, {r("value")} AS value, {r("lag(value, 4) OVER w")} AS yoy_lag,
       {r("value - lag(value, 4) OVER w")} AS yoy_diff, {r("value / lag(value, 4) OVER w - 1")} AS yoy_pct
FROM series WINDOW w AS (PARTITION BY series_id ORDER BY ts)
""")
def year_over_year(t):
    return publish(frames.lag_diff(_series(t), ["series_id"], "ts", "value", 4, "yoy_"))


@query(f"""
WITH {_SERIES_SQL},
x AS (SELECT series_id, CASE WHEN ts <= DATE '1998-04-01' THEN pct END AS a, CASE WHEN ts >= DATE '1998-04-01' THEN pct END AS b FROM steps)
SELECT series_id, count(a) AS pre_n, {r("avg(a)")} AS pre_mean, {r("stddev_samp(a)")} AS pre_std, count(b) AS post_n,
       {r("avg(b)")} AS post_mean, {r("stddev_samp(b)")} AS post_std FROM x GROUP BY 1
""")
def regimes(t):
    changes = timeseries.stationary(_series(t)).select(
        "series_id", "ts", F.col("pct_change").alias("value")
    )
    return publish(timeseries.regimes(changes, "1998-04-01"))


@query(f"""
WITH {_SERIES_SQL},
m AS (SELECT *, CASE WHEN diff IS NOT NULL THEN avg(diff) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING) END AS mean_step FROM steps)
SELECT series_id, {_iso("ts")} AS ts, {r("value")} AS value, {r("diff")} AS diff, {r("lag(mean_step, 8) OVER w")} AS forecast_diff,
       {r("lag(value, 8) OVER w + 8 * lag(mean_step, 8) OVER w")} AS forecast_level
FROM m WINDOW w AS (PARTITION BY series_id ORDER BY ts)
""")
def naive_long(t):
    return publish(timeseries.naive_long(_series(t), 8))


def _differences(t):
    return timeseries.differenced(_series(t))


@query(f"""
WITH {_DIFF_SQL}
SELECT series_id, CAST(n AS BIGINT) AS n, {r("alpha")} AS alpha, {r("beta")} AS beta, {r("r2")} AS r2 FROM fit
""")
def ar1_fit(t):
    return publish(timeseries.ar1_fit(_differences(t)))


@query(f"""
WITH {_DIFF_SQL}
SELECT series_id, {_iso("ts")} AS ts, {r("value")} AS value, {r("alpha + beta * x")} AS fitted FROM d JOIN fit USING (series_id)
""")
def ar1_in_sample(t):
    series = _differences(t)
    return publish(timeseries.ar1_in_sample(series, timeseries.ar1_fit(series)))


@query(f"""
WITH {_DIFF_SQL},
e AS (SELECT series_id, max(ts) AS last_ts, arg_max(value, ts) AS y FROM d GROUP BY 1),
g AS (SELECT *, unnest(range(1, 11)) AS h FROM e JOIN fit USING (series_id))
SELECT series_id, {_iso("last_ts + to_months(CAST(3 * h AS INTEGER))")} AS ts, h AS horizon,
       {r("alpha * (1 - power(beta, h)) / (1 - beta) + power(beta, h) * y")} AS forecast FROM g
""")
def ar1_forecast(t):
    series = _differences(t)
    return publish(timeseries.ar1_forecast(series, 10, timeseries.ar1_fit(series)))


@query(f"""
WITH {_DIFF_SQL},
e AS (SELECT series_id, max(ts) AS last_ts, arg_max(value, ts) AS y, avg(value) AS mu FROM d GROUP BY 1),
g AS (SELECT *, unnest(range(1, 7)) AS h FROM e)
SELECT series_id, {_iso("last_ts + to_months(CAST(3 * h AS INTEGER))")} AS ts, h AS horizon,
       {r("0.5 * mu * (1 - power(0.5, h)) / 0.5 + power(0.5, h) * y")} AS forecast FROM g
""")
def ar1_mean_reverting(t):
    return publish(timeseries.ar1_forecast(_differences(t), 6, beta=0.5))


_BACKTEST_SQL = """vint AS (SELECT * FROM params WHERE ts BETWEEN DATE '1997-01-01' AND DATE '2000-10-01'),
grid AS (SELECT *, unnest(range(1, 9)) AS h FROM vint),
f AS (SELECT series_id, ts AS vintage, h AS horizon, CAST(ts + to_months(CAST(3 * h AS INTEGER)) AS DATE) AS due,
             alpha * (1 - power(beta, h)) / (1 - beta) + power(beta, h) * value AS forecast FROM grid),
bt AS (SELECT f.*, d.value AS actual, d.value - forecast AS error FROM f LEFT JOIN d ON d.series_id = f.series_id AND d.ts = due)"""


@query(f"""
WITH {_DIFF_SQL}, params AS (SELECT d.*, alpha, beta FROM d JOIN fit USING (series_id)), {_BACKTEST_SQL}
SELECT horizon, count(error) AS n, {r("avg(error)")} AS mean_error, {r("avg(abs(error))")} AS mae, {r("avg(error * error)")} AS mse
FROM bt GROUP BY 1
""")
def backtest_errors(t):
    tested = timeseries.backtest(_differences(t), 8, "1997-01-01", "2000-10-01")
    return publish(timeseries.error_by_horizon(tested))


@query(f"""
WITH {_DIFF_SQL},
params AS (SELECT series_id, ts, value, CASE WHEN n >= 3 THEN a END AS alpha, CASE WHEN n >= 3 THEN b END AS beta FROM (
  SELECT series_id, ts, value, regr_count(value, x) OVER w AS n, regr_intercept(value, x) OVER w AS a, regr_slope(value, x) OVER w AS b
  FROM d WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING))), {_BACKTEST_SQL}
SELECT series_id, {_iso("vintage")} AS vintage, horizon, {_iso("due")} AS ts, {r("forecast")} AS forecast, {r("actual")} AS actual,
       {r("error")} AS error FROM bt
""")
def backtest_refit(t):
    return publish(
        timeseries.backtest(_differences(t), 8, "1997-01-01", "2000-10-01", refit=True)
    )


# The p-value polynomials of the unit-root test at tau, and the normal tail below their value.
_ADF_Z = """(CASE WHEN tau <= -1.61 THEN 2.1659 + 1.4412 * tau + 0.038269 * tau * tau
  ELSE 1.7339 + 0.93202 * tau - 0.12745 * tau * tau - 0.010368 * tau * tau * tau END)"""
_ADF_P = f"""(CASE WHEN tau > 2.74 THEN 1.0 WHEN tau < -18.83 THEN 0.0
  WHEN {_ADF_Z} < 0 THEN {two_sided_sql(_ADF_Z)} / 2 ELSE 1 - {two_sided_sql(_ADF_Z)} / 2 END)"""


@query(f"""
WITH {_SERIES_SQL},
g AS (SELECT series_id, count(*) AS n, regr_slope(diff, before) AS b, regr_sxx(diff, before) AS sxx, regr_syy(diff, before) AS syy,
             regr_sxy(diff, before) AS sxy FROM steps WHERE diff IS NOT NULL GROUP BY 1)
SELECT series_id, {r("tau")} AS statistic, {r(_ADF_P)} AS p_value, 0 AS lags, n,
       {r("-3.43035 - 6.5393 / n - 16.786 / (n * n) - 79.433 / (n * n * n)")} AS critical_1pct,
       {r("-2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.04 / (n * n * n)")} AS critical_5pct,
       {r("-2.56677 - 1.5384 / n - 2.809 / (n * n)")} AS critical_10pct
FROM (SELECT *, b / sqrt((syy - b * sxy) / (n - 2) / sxx) AS tau FROM g)
""")
def adf_stat(t):
    return publish(timeseries.adf(_series(t), 0, select_lag=False))


@query(f"""
WITH {_SERIES_SQL},
z AS (SELECT series_id, diff AS y, before AS a, lag(diff) OVER (PARTITION BY series_id ORDER BY ts) AS b FROM steps),
m AS (SELECT series_id, count(*) AS n, regr_sxx(y, a) AS saa, regr_sxx(y, b) AS sbb, regr_sxy(a, b) AS sab,
             regr_sxy(y, a) AS say, regr_sxy(y, b) AS sby, regr_syy(y, a) AS syy
      FROM z WHERE y IS NOT NULL AND b IS NOT NULL GROUP BY 1),
c AS (SELECT *, saa * sbb - sab * sab AS det, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ca,
             (sby * saa - say * sab) / (saa * sbb - sab * sab) AS cb FROM m)
SELECT series_id, {r("ca / sqrt((syy - ca * say - cb * sby) / (n - 3) * sbb / det)")} AS statistic, 1 AS lags, n FROM c
""")
def adf_one_lag(t):
    test = timeseries.adf(_series(t), 1, select_lag=False)
    return publish(test.select("series_id", "statistic", "lags", "n"))


def _swept_sql(source: str, name: str) -> str:
    """The 7 x 7 sums of products of ``source`` (series_id, z), swept column by column."""
    return f"""
{name}_c AS (SELECT series_id, i, j, sum(z[i + 1] * z[j + 1]) AS v, count(*) AS n
  FROM {source}, range(7) AS a(i), range(7) AS b(j) GROUP BY ALL),
{name}_m AS (SELECT series_id, max(n) AS n, list(v ORDER BY i, j) AS m FROM {name}_c GROUP BY 1),
{name} AS (
  SELECT series_id, n, 0 AS k, m FROM {name}_m
  UNION ALL
  SELECT series_id, n, k + 1, CASE WHEN m[(k + 1) * 8 + 1] > 1e-12 THEN list_transform(range(49), lambda c:
    CASE WHEN c // 7 = k + 1 AND c % 7 = k + 1 THEN -1 / m[(k + 1) * 8 + 1]
         WHEN c // 7 = k + 1 OR c % 7 = k + 1 THEN m[c + 1] / m[(k + 1) * 8 + 1]
         ELSE m[c + 1] - m[(c // 7) * 7 + k + 2] * m[(k + 1) * 7 + c % 7 + 1] / m[(k + 1) * 8 + 1] END) ELSE m END
  FROM {name} WHERE k < 6)"""


@query(f"""
WITH RECURSIVE {_SERIES_SQL},
s AS (SELECT series_id, ts, diff, before - first_value(value) OVER w AS lev, lag(diff, 1) OVER w AS d1, lag(diff, 2) OVER w AS d2,
             lag(diff, 3) OVER w AS d3, lag(diff, 4) OVER w AS d4 FROM steps WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
common AS (SELECT series_id, [diff, lev, 1, d1, d2, d3, d4] AS z FROM s WHERE d4 IS NOT NULL),
{_swept_sql("common", "f")},
aic AS (SELECT series_id, k - 2 AS lags, n * (ln(2 * pi()) + ln(m[1] / n) + 1) + 2 * k AS aic FROM f WHERE k >= 2),
best AS (SELECT series_id, lags FROM aic QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY aic, lags) = 1),
own AS (SELECT series_id, [diff, lev, 1, CASE WHEN lags > 0 THEN d1 ELSE 0 END, CASE WHEN lags > 1 THEN d2 ELSE 0 END,
               CASE WHEN lags > 2 THEN d3 ELSE 0 END, CASE WHEN lags > 3 THEN d4 ELSE 0 END] AS z
        FROM s JOIN best USING (series_id) WHERE diff IS NOT NULL AND [diff, d1, d2, d3, d4][lags + 1] IS NOT NULL),
{_swept_sql("own", "h")},
t AS (SELECT series_id, lags, n, m[2] / sqrt(m[1] / (n - k) * -m[9]) AS tau FROM h JOIN best USING (series_id) WHERE k = lags + 2)
SELECT series_id, {r("tau")} AS statistic, {r(_ADF_P)} AS p_value, CAST(lags AS INTEGER) AS lags, n,
       {r("-3.43035 - 6.5393 / n - 16.786 / (n * n) - 79.433 / (n * n * n)")} AS critical_1pct,
       {r("-2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.04 / (n * n * n)")} AS critical_5pct,
       {r("-2.56677 - 1.5384 / n - 2.809 / (n * n)")} AS critical_10pct FROM t
""")
def adf_by_aic(t):
    return publish(timeseries.adf(_series(t), 4))


@query("""
WITH q AS (SELECT CAST(g AS DATE) AS quarter FROM generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2002-10-01', INTERVAL 3 MONTH) AS s(g)),
n AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, count(*) AS orders FROM orders GROUP BY 1)
SELECT strftime(quarter, '%Y-%m-%d') AS quarter, coalesce(orders, 0) AS orders FROM q LEFT JOIN n USING (quarter)
""")
def orders_per_quarter(t):
    """Orders of every quarter of a range, quarters without orders included."""
    quarter = F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("quarter")
    counted = t.orders.groupBy(quarter).agg(F.count(F.lit(1)).alias("orders"))
    grid = quarters(t.spark, "1990-01-01", "2002-10-01")
    return publish(grid.join(counted, "quarter", "left").select("quarter", F.coalesce("orders", F.lit(0)).alias("orders")))


# --- attribution -------------------------------------------------------------


def _monthly(t):
    """Returned and all lines per segment and ship month."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    clients = t.customer.select("c_custkey", "c_mktsegment")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month")
    # Per order and month first: the joins meet counts instead of lines.
    counts = t.lineitem.groupBy("l_orderkey", month).agg(
        F.count_if(F.expr("l_returnflag = 'R'")).alias("num"), F.count(F.lit(1)).alias("den")
    )
    joined = counts.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        clients, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.groupBy(F.col("c_mktsegment").alias("segment"), "month").agg(
        F.sum("num").alias("num"), F.sum("den").alias("den")
    )


_MONTHLY_SQL = """monthly AS (
  SELECT c_mktsegment AS segment, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS num, count(*) AS den
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
cum AS (SELECT *, CAST(sum(num) OVER w AS BIGINT) AS cn, CAST(sum(den) OVER w AS BIGINT) AS cd
        FROM monthly WINDOW w AS (PARTITION BY segment ORDER BY month))"""


@query(f"""
WITH {_MONTHLY_SQL}
SELECT segment, {_iso("month")} AS month, num, den, cn AS cum_num, cd AS cum_den, {r("cn / nullif(cd, 0)")} AS cum_ratio FROM cum
""")
def cumulative_ratio(t):
    return publish(
        attribution.cumulative_ratio(_monthly(t), ["segment"], "month", "num", "den")
    )


@query(f"""
WITH {_MONTHLY_SQL},
g AS (SELECT *, (cn / cd) / nullif(lag(cn) OVER w / lag(cd) OVER w, 0) - 1 AS growth, ln(cn / nullif(lag(cn) OVER w, 0)) AS fnum,
             ln(lag(cd) OVER w / cd) AS fden FROM cum WINDOW w AS (PARTITION BY segment ORDER BY month))
SELECT segment, {_iso("month")} AS month, {r("growth")} AS growth, {r("fnum")} AS from_num, {r("fden")} AS from_den,
       {r("abs(growth - (fnum + fden))")} AS abs_error FROM g
""")
def log_attribution(t):
    out = attribution.log_attribution(_monthly(t), ["segment"], "month", "num", "den")
    return publish(out.select("segment", "month", "growth", "from_num", "from_den", "abs_error"))


def _revenue(t):
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month")
    money = F.sum(v.money("l_extendedprice")).cast("double") / 1e6
    return t.lineitem.groupBy("l_returnflag", month).agg(
        money.alias("revenue"), F.sum(F.col("l_quantity").cast("long")).alias("volume")
    )


_REVENUE_SQL = """rev AS (
  SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000000.0::DOUBLE AS r, CAST(sum(l_quantity) AS BIGINT) AS q
  FROM lineitem GROUP BY 1, 2),
l AS (SELECT *, r / q AS p, lag(r) OVER w AS r0, lag(q) OVER w AS q0, lag(r / q) OVER w AS p0
      FROM rev WINDOW w AS (PARTITION BY l_returnflag ORDER BY month))"""


@query(f"""
WITH {_REVENUE_SQL}
SELECT l_returnflag, {_iso("month")} AS month, {r("r - r0")} AS revenue_change, {r("(p - p0) * q0")} AS price_effect,
       {r("(q - q0) * p0")} AS volume_effect, {r("(p - p0) * (q - q0)")} AS interaction, {r("ln(r / r0)")} AS log_growth,
       {r("ln(p / p0)")} AS log_price, {r("ln(q / q0)")} AS log_volume FROM l
""")
def price_volume(t):
    out = attribution.price_volume(_revenue(t), ["l_returnflag"], "month", "revenue", "volume")
    return publish(out.drop("revenue", "volume", "price"))


@query(f"""
WITH {_REVENUE_SQL}
SELECT l_returnflag, count(r0) AS periods, {r("sum(ln(r / r0))")} AS total_log_return, {r("avg(ln(r / r0))")} AS mean_log_return,
       {r("arg_max(r, month) / arg_min(r, month) - 1")} AS compounded_return FROM l GROUP BY 1
""")
def log_returns(t):
    return publish(attribution.log_returns(_revenue(t), ["l_returnflag"], "month", "revenue"))


# --- places ------------------------------------------------------------------

_LAT, _LON = "double(k * 37 % 120 - 60)", "double(k * 53 % 360 - 180)"


def _sites(t):
    return t.nation.selectExpr("n_name AS site", "n_nationkey AS k").selectExpr(
        "site", f"{_LAT} AS lat", f"{_LON} AS lon"
    )


def _points(t):
    return t.customer.selectExpr("c_custkey", "c_custkey % 977 AS k").selectExpr(
        "c_custkey", f"{_LAT} AS lat", f"{_LON} AS lon"
    )


_SITES_SQL = """sites AS (SELECT n_name AS site, CAST(n_nationkey * 37 % 120 - 60 AS DOUBLE) AS lat,
  CAST(n_nationkey * 53 % 360 - 180 AS DOUBLE) AS lon FROM nation),
points AS (SELECT c_custkey, CAST(c_custkey % 977 * 37 % 120 - 60 AS DOUBLE) AS lat,
  CAST(c_custkey % 977 * 53 % 360 - 180 AS DOUBLE) AS lon FROM customer)"""


def _km(a: str, b: str) -> str:
    h = (
        f"(power(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))"
        f" * power(sin(radians({b}.lon - {a}.lon) / 2), 2))"
    )
    return f"(2 * 6371.0 * asin(sqrt(least(1.0, {h}))))"


@query(f"""
WITH {_SITES_SQL}, x AS (SELECT c_custkey, site, {_km("points", "sites")} AS km FROM points, sites)
SELECT c_custkey, site AS nearest_site, {r("km", 5)} AS km FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY round(km, 8), site) AS rn FROM x) WHERE rn = 1
""")
def nearest_site(t):
    return publish(geo.nearest(_points(t), _sites(t), "c_custkey", "site"), 5)


@query(f"""
WITH {_SITES_SQL}
SELECT a.site AS site_a, b.site AS site_b, {r(_km("a", "b"), 5)} AS km FROM sites a JOIN sites b ON a.site <> b.site
""")
def distance_matrix(t):
    return publish(geo.distance_matrix(_sites(t), "site"), 5)
