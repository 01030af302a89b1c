"""Panels of period-grain series: ``(series_id, ts, value)``.

Facts are reduced to one row per series and period first. The windows below are
partitioned by series and therefore hold at most one row per period.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import normal_cdf

_PERIOD_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _along(*, rows: tuple[int, int] | None = None):
    w = Window.partitionBy("series_id").orderBy("ts")
    return w.rowsBetween(*rows) if rows else w


_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def to_series(df: DataFrame, ts: str, value: Column, grain: str, series: Column) -> DataFrame:
    """Aggregate facts to ``(series_id, ts, value)``; ``value`` is an aggregate."""
    return df.groupBy(
        series.alias("series_id"), F.trunc(F.col(ts).cast("date"), grain).alias("ts")
    ).agg(value.alias("value"))


def between_dates(series: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Slice of the series, both ends included."""
    if start is not None:
        series = series.where(F.col("ts") >= F.lit(start).cast("date"))
    if end is not None:
        series = series.where(F.col("ts") <= F.lit(end).cast("date"))
    return series


def stationary(series: DataFrame) -> DataFrame:
    """Add first difference and percent change; a gap in the values stays a gap."""
    before = F.lag("value").over(_along())
    return series.withColumns(
        {
            "diff": F.col("value") - before,
            "pct_change": F.try_divide(F.col("value"), before) - 1,
        }
    )


def differenced(series: DataFrame) -> DataFrame:
    """The first-difference series itself, without its empty first period."""
    return (
        stationary(series)
        .where("diff IS NOT NULL")
        .select("series_id", "ts", F.col("diff").alias("value"))
    )


def regimes(series: DataFrame, break_date: str) -> DataFrame:
    """Mean and standard deviation (n-1) before and after a date, which counts on both sides."""
    cut = F.lit(break_date).cast("date")
    pre = F.when(F.col("ts") <= cut, F.col("value"))
    post = F.when(F.col("ts") >= cut, F.col("value"))
    return series.groupBy("series_id").agg(
        F.count(pre).alias("pre_n"),
        F.avg(pre).alias("pre_mean"),
        F.stddev_samp(pre).alias("pre_std"),
        F.count(post).alias("post_n"),
        F.avg(post).alias("post_mean"),
        F.stddev_samp(post).alias("post_std"),
    )


def naive_long(series: DataFrame, periods: int) -> DataFrame:
    """Long-horizon forecast made ``periods`` ago from the mean difference then known."""
    steps = stationary(series)
    mean_step = F.avg("diff").over(_along(rows=_SO_FAR))
    return (
        steps.withColumn("_mean_step", F.when(F.col("diff").isNotNull(), mean_step))
        .withColumn("forecast_diff", F.lag("_mean_step", periods).over(_along()))
        .withColumn(
            "forecast_level",
            F.lag("value", periods).over(_along()) + F.col("forecast_diff") * periods,
        )
        .drop("_mean_step", "pct_change")
    )


def ar1_fit(series: DataFrame) -> DataFrame:
    """Regression of each series on its previous value, missing pairs dropped."""
    pairs = series.withColumn("_x", F.lag("value").over(_along()))
    return pairs.groupBy("series_id").agg(
        F.regr_count("value", "_x").alias("n"),
        F.regr_intercept("value", "_x").alias("alpha"),
        F.regr_slope("value", "_x").alias("beta"),
        F.regr_r2("value", "_x").alias("r2"),
    )


def ar1_in_sample(series: DataFrame, params: DataFrame) -> DataFrame:
    """Fitted value of every period from its actual predecessor."""
    joined = series.join(params.select("series_id", "alpha", "beta"), "series_id")
    before = F.lag("value").over(_along())
    return joined.withColumn("fitted", F.col("alpha") + F.col("beta") * before).drop(
        "alpha", "beta"
    )


def _ahead(h: Column, last: Column, alpha: Column, beta: Column) -> Column:
    power = F.pow(beta, h.cast("double"))
    return F.when(beta == 1.0, alpha * h + last).otherwise(
        alpha * (1 - power) / (1 - beta) + power * last
    )


def ar1_forecast(
    series: DataFrame, steps: int, params: DataFrame | None = None, beta: float = 0.1, grain: str = "quarter"
) -> DataFrame:
    """Iterated forecasts 1..``steps`` periods past the end of each series.

    ``params`` holds ``(series_id, alpha, beta)``. Without it ``beta`` is used for
    every series; a missing alpha becomes (1 - beta) times the series mean.
    """
    ends = series.groupBy("series_id").agg(
        F.max("ts").alias("_end"),
        F.max_by("value", "ts").alias("_last"),
        F.avg("value").alias("_mean"),
    )
    if params is None:
        ends = ends.withColumns({"alpha": F.lit(None).cast("double"), "beta": F.lit(float(beta))})
    else:
        ends = ends.join(params.select("series_id", "alpha", "beta"), "series_id")
    alpha = F.coalesce(F.col("alpha"), (1 - F.col("beta")) * F.col("_mean"))
    months = _PERIOD_MONTHS[grain]
    return ends.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select(
        "series_id",
        F.add_months("_end", F.col("horizon") * months).alias("ts"),
        "horizon",
        _ahead(F.col("horizon"), F.col("_last"), alpha, F.col("beta")).alias("forecast"),
    )


def backtest(
    series: DataFrame,
    steps: int,
    start: str,
    end: str,
    refit: bool = False,
    grain: str = "quarter",
) -> DataFrame:
    """Forecasts of every vintage from ``start`` to ``end`` against what came later.

    ``refit=False`` estimates once on the whole series (pseudo out of sample);
    ``refit=True`` estimates each vintage on the values known by then; a vintage with
    fewer than three pairs of values has NULL forecasts. Horizons start at 1; a forecast
    for a period without an actual has a NULL error.
    """
    if refit:
        pairs = series.withColumn("_x", F.lag("value").over(_along()))
        known = _along(rows=_SO_FAR)
        enough = F.regr_count("value", "_x").over(known) >= 3
        vintages = pairs.select(
            "series_id",
            "ts",
            "value",
            F.when(enough, F.regr_intercept("value", "_x").over(known)).alias("alpha"),
            F.when(enough, F.regr_slope("value", "_x").over(known)).alias("beta"),
        )
    else:
        vintages = series.join(ar1_fit(series).select("series_id", "alpha", "beta"), "series_id")
    chosen = between_dates(vintages, start, end).select(
        "series_id",
        F.col("ts").alias("vintage"),
        F.col("value").alias("_last"),
        "alpha",
        "beta",
    )
    months = _PERIOD_MONTHS[grain]
    grid = chosen.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select(
        "series_id",
        "vintage",
        "horizon",
        F.add_months("vintage", F.col("horizon") * months).alias("ts"),
        _ahead(F.col("horizon"), F.col("_last"), F.col("alpha"), F.col("beta")).alias("forecast"),
    )
    actual = series.select("series_id", "ts", F.col("value").alias("actual"))
    return grid.join(actual, ["series_id", "ts"], "left").withColumn(
        "error", F.col("actual") - F.col("forecast")
    )


def error_by_horizon(backtested: DataFrame) -> DataFrame:
    """Mean, mean absolute and mean squared error per horizon."""
    return backtested.groupBy("horizon").agg(
        F.count("error").alias("n"),
        F.avg("error").alias("mean_error"),
        F.avg(F.abs("error")).alias("mae"),
        F.avg(F.col("error") * F.col("error")).alias("mse"),
    )


# Response-surface constants for a test with intercept, from
# MacKinnon (2010), "Critical Values for Cointegration Tests", and the p-value
# polynomials of MacKinnon (1994).
_CRITICAL = {
    "critical_1pct": (-3.43035, -6.5393, -16.786, -79.433),
    "critical_5pct": (-2.86154, -2.8903, -4.234, -40.040),
    "critical_10pct": (-2.56677, -1.5384, -2.809, 0.0),
}
_TAU_STAR, _TAU_MIN, _TAU_MAX = -1.61, -18.83, 2.74
_SMALL_P = (2.1659, 1.4412, 0.038269)
_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p_value(tau: Column) -> Column:
    """P value of the test statistic from the published polynomials."""

    def poly(coefficients: tuple[float, ...]) -> Column:
        out = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            out = out * tau + c
        return out

    z = F.when(tau <= _TAU_STAR, poly(_SMALL_P)).otherwise(poly(_LARGE_P))
    inside = F.when(tau > _TAU_MAX, 1.0).when(tau < _TAU_MIN, 0.0).otherwise(normal_cdf(z))
    return F.when(tau.isNotNull(), inside)


def _swept(matrix: Column, width: int, k: int) -> Column:
    """``matrix`` (rows one after the other) after solving for column ``k``.

    Of a matrix of sums of products whose first column is the target, the columns solved for then hold
    coefficients in the first row and minus the inverse among themselves, and the first element is the sum
    of squared residuals. A column that is a combination of earlier ones, or 0, is left as it is.
    """

    def entry(cell: Column, m: Column) -> Column:
        i, j = F.floor(cell / width).cast("int"), F.pmod(cell, F.lit(width)).cast("int")
        pivot = F.get(m, F.lit(k * width + k))
        here, row, column = F.get(m, cell), F.get(m, i * width + k), F.get(m, k * width + j)
        solved = (
            F.when((i == k) & (j == k), -1 / pivot)
            .when((i == k) | (j == k), here / pivot)
            .otherwise(here - row * column / pivot)
        )
        return F.when(pivot > 1e-12, solved).otherwise(here)

    cells = F.sequence(F.lit(0), F.lit(width * width - 1))
    return F.flatten(F.transform(F.array(matrix), lambda m: F.transform(cells, lambda cell: entry(cell, m))))


def _solved(sums: DataFrame, width: int) -> DataFrame:
    """Add ``_rss`` and ``_tau`` by lag: residual sum of squares and t statistic of the level term.

    Columns are scaled to length 1 first, so that one bound tells a dependent column.
    """
    index = {p: n for n, p in enumerate((i, j) for i in range(width) for j in range(i, width))}
    at = lambda i, j: F.col("gram")[index[min(i, j), max(i, j)]]
    scale = [F.sqrt(F.when(at(i, i) > 0, at(i, i)).otherwise(1.0)) for i in range(width)]
    state = sums.withColumns(
        {"_m": F.array(*[at(i, j) / (scale[i] * scale[j]) for i in range(width) for j in range(width)]), "_yy": at(0, 0)}
    )
    rss, tau = [], []
    for k in range(1, width):
        state = state.withColumn("_m", _swept(F.col("_m"), width, k))
        if k >= 2:
            left = F.greatest(F.get("_m", F.lit(0)), F.lit(0.0))
            inverse = -F.get("_m", F.lit(width + 1))
            error = F.sqrt(left / (F.col("n") - k) * inverse)
            state = state.withColumns(
                {
                    f"_rss{k - 2}": left * F.col("_yy"),
                    f"_tau{k - 2}": F.when((F.col("n") > k) & (inverse > 0) & (error > 0), F.get("_m", F.lit(1)) / error),
                }
            )
            rss.append(f"_rss{k - 2}")
            tau.append(f"_tau{k - 2}")
    return state.withColumns({"_rss": F.array(*rss), "_tau": F.array(*tau)}).drop("_m", "_yy", *rss, *tau)


def _products(frame: DataFrame, width: int, also: list[str] | None = None) -> DataFrame:
    """Upper triangle of the sums of products of ``_z`` per series, as one array."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    z = F.col("_z")
    return frame.groupBy("series_id", *(also or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(z[i] * z[j]) for i, j in pairs]).alias("gram"),
    )


def adf(series: DataFrame, max_lag: int, select_lag: bool = True) -> DataFrame:
    """Augmented Dickey-Fuller test with intercept, per series.

    With ``select_lag`` the number of lagged differences is the one of lowest AIC
    among 0..``max_lag`` on their common sample, and the test is then run on all
    rows that lag allows; otherwise it is ``max_lag``. Each series is reduced to
    its sums of products, and these are solved column by column, which gives all
    lags in one go. A series too short or too flat has no statistic.
    """
    width = max_lag + 3
    first = F.first("value", ignorenulls=True).over(
        _along(rows=(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    shifted = series.where("value IS NOT NULL").withColumn("_y", F.col("value") - first)
    steps = shifted.withColumn("_level", F.lag("_y").over(_along())).withColumn(
        "_d", F.col("_y") - F.col("_level")
    )
    lagged = [F.lag("_d", i).over(_along()) for i in range(1, max_lag + 1)]
    rows = steps.withColumn(
        "_z", F.array("_d", "_level", F.lit(1.0), *lagged)
    ).where("_d IS NOT NULL")
    full = F.forall("_z", lambda v: v.isNotNull())

    if select_lag:
        n = F.col("n").cast("double")
        size = lambda p: F.lit(2.0) * (p + 2)
        aic = F.transform(
            "_rss",
            lambda rss, p: F.when(n <= p + 2, float("inf"))
            .when(rss > 0, n * (math.log(2 * math.pi) + F.ln(rss / n) + 1) + size(p))
            .otherwise(float("-inf")),
        )
        lowest = _solved(_products(rows.where(full), width), width).select("series_id", aic.alias("_aic"))
        chosen = lowest.select("series_id", (F.array_position("_aic", F.array_min("_aic")) - 1).cast("int").alias("lags"))
        rows = rows.join(chosen, "series_id")
    else:
        rows = rows.withColumn("lags", F.lit(max_lag))
    # Columns beyond the chosen lag count as 0, so one layout serves all series.
    used = F.transform(
        "_z", lambda v, i: F.when(i <= F.col("lags") + 2, v).otherwise(F.lit(0.0))
    )
    used_rows = rows.withColumn("_z", used).where(full)
    sums = _products(used_rows, width, ["lags"])
    tau = F.get("_tau", F.col("lags"))
    out = _solved(sums, width).withColumn("_t", F.struct(tau.alias("statistic"), adf_p_value(tau).alias("p_value")))
    n = F.col("n").cast("double")
    return out.select(
        "series_id",
        "_t.statistic",
        "_t.p_value",
        "lags",
        "n",
        *[
            (a + b / n + c / (n * n) + d / (n * n * n)).alias(name)
            for name, (a, b, c, d) in _CRITICAL.items()
        ],
    )
