"""Regressions and series against numpy."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.operators import attribution, regression, timeseries
from waybill.operators.regression import Design


def _ols(x, y):
    x = np.column_stack([x, np.ones(len(y))])
    coef, *_ = np.linalg.lstsq(x, y, rcond=None)
    residual = y - x @ coef
    s2 = residual @ residual / (len(y) - x.shape[1])
    return coef, np.sqrt(np.diag(s2 * np.linalg.inv(x.T @ x))), residual


@pytest.fixture(scope="module")
def grades(frame):
    rng = random.Random(12)
    rows = []
    for _ in range(120):
        school = rng.choice(["north side", "south", "west"])
        a, b = rng.uniform(2, 4), rng.uniform(500, 800)
        lift = {"north side": 0.0, "south": 0.6, "west": -0.4}[school]
        rows.append((0.5 * a + 0.002 * b + lift + rng.gauss(0, 0.2), a, b, school))
    return frame("y double, a double, b double, school string", rows)


def test_ols_with_categories_and_interaction(grades):
    design = Design(
        ["a", "b"],
        {"school": regression.category(grades, "school")},
        [("a", "b")],
    )
    fit = regression.ols(grades, "y", design)
    pdf = grades.toPandas()
    x = np.column_stack(
        [pdf.a, pdf.b, pdf.school == "south", pdf.school == "west", pdf.a * pdf.b]
    ).astype(float)
    coef, error, residual = _ols(x, pdf.y.to_numpy())
    got = {r.term: r for r in fit.coefficients.collect()}
    terms = ["a", "b", "school_south", "school_west", "a:b", "intercept"]
    assert [got[t].coefficient for t in terms] == pytest.approx(list(coef), rel=1e-6)
    assert [got[t].std_error for t in terms] == pytest.approx(list(error), rel=1e-6)
    r2 = 1 - residual @ residual / ((pdf.y - pdf.y.mean()) ** 2).sum()
    assert fit.quality.collect()[0].r2 == pytest.approx(r2)
    fitted = fit.predict(grades).agg(F.avg(F.col("residual") * F.col("residual"))).collect()[0][0]
    assert fitted == pytest.approx(residual @ residual / len(pdf))


def test_rows_without_target_or_regressor_are_scored(grades, frame):
    design = Design(["a", "b"], {"school": regression.category(grades, "school")})
    fit = regression.ols(grades, "y", design)
    new = frame("y double, a double, b double, school string", [(None, 3.0, 600.0, "south"), (1.0, None, 600.0, "west")])
    got = {r.school: r for r in fit.predict(new).collect()}
    assert got["south"].fitted is not None and got["south"].residual is None
    assert got["west"].fitted is None and got["west"].residual is None
    marks = frame("y int, x double", [(int(k % 3 == 0), float(k % 7)) for k in range(60)] + [(None, 2.0), (1, None)])
    scored = regression.logistic_scores(marks, "y", ["x"]).collect()
    assert len(scored) == 62
    assert sum(r.probability is None for r in scored) == 1


def test_adding_the_category_raises_r2(grades):
    levels = regression.category(grades, "school")
    fits = {
        "numbers": regression.ols(grades, "y", Design(["a", "b"])),
        "with school": regression.ols(grades, "y", Design(["a", "b"], {"school": levels})),
    }
    r2 = {r.model: r.r2 for r in regression.compare_models(fits).collect()}
    assert r2["with school"] > r2["numbers"] + 0.1


def test_logit_equals_log_odds_ratio_and_wald(frame):
    from waybill.operators import bayes

    cells = {(1, 1): 40, (1, 0): 60, (0, 1): 25, (0, 0): 90}
    df = frame("x int, y int", [k for k, n in cells.items() for _ in range(n)])
    wald = bayes.wald_log_odds_ratio(
        bayes.two_by_two(df, F.col("x") == 1, F.col("y") == 1)
    ).collect()[0]
    for aggregated in (True, False):
        got = {r.term: r for r in regression.logit_fit(df, "y", ["x"], aggregated).collect()}
        assert got["x"].coefficient == pytest.approx(wald.log_odds_ratio, abs=1e-8)
        assert got["x"].std_error == pytest.approx(wald.std_error, abs=1e-8)
        assert got["x"].p_value == pytest.approx(wald.p_value, abs=1e-8)


def test_logistic_scores_are_group_shares(frame):
    df = frame("x int, y int", [(0, 0)] * 30 + [(0, 1)] * 10 + [(1, 0)] * 10 + [(1, 1)] * 40)
    got = regression.logistic_scores(df, "y", ["x"]).groupBy("x").agg(F.max("probability").alias("p"))
    assert {r.x: r.p for r in got.collect()} == pytest.approx({0: 0.25, 1: 0.8}, abs=1e-4)


@pytest.fixture(scope="module")
def series(frame):
    rng = random.Random(6)
    rows = []
    for name, beta in (("slow", 0.9), ("fast", 0.2)):
        y = 100.0
        for i in range(60):
            y = 10 + beta * (y - 10) + rng.gauss(0, 1) + (0.5 * i if name == "fast" else 0)
            rows.append((name, dt.date(2000 + i // 4, 1 + 3 * (i % 4), 1), y))
    return frame("series_id string, ts date, value double", rows)


def _values(series, name):
    return np.array(
        [r.value for r in series.where(F.col("series_id") == name).orderBy("ts").collect()]
    )


def _adf(y, lag, skip):
    d = np.diff(y)
    first = max(lag, skip)
    target = d[first:]
    columns = [y[first:-1]] + [d[first - i : len(d) - i] for i in range(1, lag + 1)]
    coef, error, residual = _ols(np.column_stack(columns), target)
    n = len(target)
    aic = n * (np.log(2 * np.pi) + np.log(residual @ residual / n) + 1) + 2 * (lag + 2)
    return coef[0] / error[0], aic, n


@pytest.mark.parametrize("lag", [0, 1, 3])
def test_adf_fixed_lag(series, lag):
    got = {r.series_id: r for r in timeseries.adf(series, lag, select_lag=False).collect()}
    for name in ("slow", "fast"):
        tau, _, n = _adf(_values(series, name), lag, lag)
        assert got[name].statistic == pytest.approx(tau, rel=1e-7)
        assert (got[name].lags, got[name].n) == (lag, n)


def test_adf_lag_by_aic(series):
    got = {r.series_id: r for r in timeseries.adf(series, 5).collect()}
    for name in ("slow", "fast"):
        y = _values(series, name)
        best = min(range(6), key=lambda p: _adf(y, p, 5)[1])
        tau, _, n = _adf(y, best, best)
        assert got[name].lags == best
        assert got[name].statistic == pytest.approx(tau, rel=1e-7)
        assert got[name].n == n
        assert 0 <= got[name].p_value <= 1


def test_adf_published_points(series):
    # The 5 % critical value of a long sample has a p-value of 5 %.
    taus = (-2.86154, -3.43035, 0.5, 3.0, -20.0)
    p = series.limit(1).select(*[timeseries.adf_p_value(F.lit(t)).alias(f"p{i}") for i, t in enumerate(taus)]).collect()[0]
    assert p["p0"] == pytest.approx(0.05, abs=1e-3)
    assert p["p1"] == pytest.approx(0.01, abs=1e-3)
    assert 0.9 < p["p2"] < 1 and p["p3"] == 1.0 and p["p4"] == 0.0


def test_forecast_equals_the_loop(series, frame):
    params = frame(
        "series_id string, alpha double, beta double", [("slow", 2.0, 0.5), ("fast", 3.0, 1.0)]
    )
    got = timeseries.ar1_forecast(series, 6, params).collect()
    for name, alpha, beta in (("slow", 2.0, 0.5), ("fast", 3.0, 1.0)):
        y = _values(series, name)[-1]
        for r in sorted((r for r in got if r.series_id == name), key=lambda r: r.horizon):
            y = alpha + beta * y
            assert r.forecast == pytest.approx(y)
        assert r.ts == dt.date(2016, 4, 1)


def test_zero_alpha_is_not_missing(series, frame):
    params = frame("series_id string, alpha double, beta double", [("slow", 0.0, 0.5)])
    got = timeseries.ar1_forecast(series, 1, params).collect()[0]
    assert got.forecast == pytest.approx(0.5 * _values(series, "slow")[-1])


def test_backtest_without_actuals_has_no_error(series):
    tested = timeseries.backtest(series, 4, "2014-01-01", "2014-10-01")
    late = tested.where("ts > DATE'2014-10-01'").collect()
    assert late and all(r.error is None and r.forecast is not None for r in late)
    errors = {r.horizon: r.n for r in timeseries.error_by_horizon(tested).collect()}
    assert errors == {1: 2 * 3, 2: 2 * 2, 3: 2 * 1, 4: 0}


def test_refit_uses_only_the_past(series):
    y = _values(series, "slow")
    got = (
        timeseries.backtest(series, 1, "2005-01-01", "2005-01-01", refit=True)
        .where("series_id = 'slow'")
        .collect()[0]
    )
    known = y[:21]
    coef, _, _ = _ols(known[:-1, None], known[1:])
    assert got.forecast == pytest.approx(coef[1] + coef[0] * known[-1])


def test_break_date_counts_on_both_sides(series):
    got = timeseries.regimes(series, "2005-01-01").where("series_id = 'slow'").collect()[0]
    assert got.pre_n + got.post_n == 61


def test_price_volume_parts_add_up(frame):
    df = frame("k string, m int, r double, v long", [("a", 1, 100.0, 10), ("a", 2, 150.0, 12), ("a", 3, 90.0, 9)])
    for row in attribution.price_volume(df, ["k"], "m", "r", "v").where("m > 1").collect():
        assert row.price_effect + row.volume_effect + row.interaction == pytest.approx(
            row.revenue_change
        )
        assert row.log_price + row.log_volume == pytest.approx(row.log_growth)


def test_log_attribution_error_is_small(frame):
    df = frame("k string, m int, a long, b long", [("x", i, 50 + i, 100 + 2 * i % 7) for i in range(12)])
    for row in attribution.log_attribution(df, ["k"], "m", "a", "b").where("m > 2").collect():
        assert row.abs_error < 0.01
        assert row.from_num + row.from_den == pytest.approx(np.log(1 + row.growth))


def test_log_returns_compound(frame):
    df = frame("k string, m int, v double", [("x", 1, 100.0), ("x", 2, 110.0), ("x", 3, 99.0)])
    got = attribution.log_returns(df, ["k"], "m", "v").collect()[0]
    assert got.total_log_return == pytest.approx(np.log(0.99))
    assert got.compounded_return == pytest.approx(-0.01)


def test_logit_reports_separation(frame):
    """x separates y: the fit says so; overlapping data converge."""
    apart = frame("y int, x double", [(int(i >= 10), float(i)) for i in range(20)])
    got = regression.logit_fit(apart, "y", ["x"]).collect()
    assert all(r.separated and not r.converged for r in got)
    mixed = frame("y int, x double", [(int(i % 3 == 0 or i > 14), float(i)) for i in range(20)])
    got = {r.term: r for r in regression.logit_fit(mixed, "y", ["x"]).collect()}
    assert all(r.converged and not r.separated for r in got.values())
    x = got["x"]
    assert x.odds_low < x.odds_ratio < x.odds_high
    assert x.odds_ratio == pytest.approx(math.exp(x.coefficient))
    few = regression.logit_fit(mixed, "y", ["x"], max_iterations=1).collect()
    assert not any(r.converged for r in few)
