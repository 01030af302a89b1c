import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from waybill import functions as fn


def _one(spark, *columns):
    return tuple(spark.range(1).select(*columns).collect()[0])


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "unit, a, b, want",
    [
        ("hour", "2020-01-01 00:59:00", "2020-01-01 01:01:00", 1),
        ("hour", "2020-01-01 01:01:00", "2020-01-01 00:59:00", -1),
        ("minute", "2020-01-01 00:00:59", "2020-01-01 00:01:00", 1),
        ("second", "2020-01-01 00:00:00.9", "2020-01-01 00:00:01.1", 1),
        ("day", "2019-12-31 23:59:00", "2020-01-01 00:00:00", 1),
        ("week", "2024-01-07 12:00:00", "2024-01-08 00:00:00", 1),
        ("month", "2020-01-31 00:00:00", "2020-02-01 00:00:00", 1),
        ("quarter", "2019-12-31 00:00:00", "2020-01-01 00:00:00", 1),
        ("year", "2019-12-31 00:00:00", "2020-01-01 00:00:00", 1),
    ],
)
def test_boundary_diff(spark, unit, a, b, want):
    assert _one(spark, fn.boundary_diff(unit, _ts(a), _ts(b))) == (want,)


def test_boundary_diff_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The clocks go forward in this night; a time-zone-free difference is 3 hours.
        diff = fn.boundary_diff("hour", _ts("2021-03-14 01:00:00"), _ts("2021-03-14 04:00:00"))
        assert _one(spark, diff) == (3,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "day, monday",
    [("2024-01-07", "2024-01-08"), ("2024-01-08", "2024-01-08"), ("2024-01-13", "2024-01-08")],
)
def test_monday_bucket_sends_sunday_forward(spark, day, monday):
    assert _one(spark, fn.monday_bucket(F.lit(day))) == (dt.date.fromisoformat(monday),)


def test_month_end_of_december_keeps_its_year(spark):
    assert _one(spark, fn.month_end(F.lit(2020), F.lit(12))) == (dt.date(2020, 12, 31),)


def test_lenient_dates(spark):
    assert _one(
        spark,
        fn.lenient_date(F.lit("2020-02-30")),
        fn.lenient_date(F.lit("n/a")),
        fn.lenient_timestamp(F.lit("2020-02-29 10:11:12")),
    ) == (None, None, dt.datetime(2020, 2, 29, 10, 11, 12))


def test_money_and_text(spark):
    assert _one(
        spark,
        fn.parse_money(F.lit("US$1,234.50")),
        fn.parse_money(F.lit("none")),
        fn.strip_quotes(F.lit('"x"')),
        fn.slug(F.lit("a b c")),
        fn.truthy(F.lit("TRUE")),
        fn.truthy(F.lit("No")),
        fn.truthy(F.lit("Not Eligible")),
    ) == (1234.5, None, "x", "a_b_c", True, False, None)


@pytest.mark.parametrize(
    "document, want",
    [
        ('{"ready":["2020-01-01","2020-02-01"]}', "2020-02-01"),
        ('{"ready":"2020-03-01"}', "2020-03-01"),
        ('{"ready":[null,"2020-04-01"]}', "2020-04-01"),
        ('{"ready":null}', None),
        ('{"other":1}', None),
        ("not json", None),
        (None, None),
    ],
)
def test_change_value(spark, document, want):
    assert _one(spark, fn.change_value(F.lit(document).cast("string"), "ready")) == (want,)


def test_safe_ratio_by_zero_is_null(spark):
    assert _one(spark, fn.safe_ratio(F.lit(1), F.lit(0)), fn.safe_ratio(F.lit(1), F.lit(4))) == (
        None,
        0.25,
    )


@pytest.mark.parametrize("n", [0, 1, 5, 20, 21, 50, 1000, 10**7])
def test_log_factorial(spark, n):
    got = _one(spark, fn.log_factorial(F.lit(n).cast("long")))[0]
    assert got == pytest.approx(math.lgamma(n + 1), rel=1e-13, abs=1e-13)


def test_logit_inverts_logistic(spark):
    assert _one(spark, fn.logistic(fn.logit(F.lit(0.2))))[0] == pytest.approx(0.2)


def test_tails(spark):
    # Even dof has the closed form exp(-x/2) * (1 + x/2); one dof is the normal tail.
    x = 5.0
    got = _one(
        spark,
        fn.chi2_sf(F.lit(x), F.lit(4)),
        fn.chi2_sf(F.lit(x), F.lit(1)),
        fn.chi2_sf(F.lit(x), F.lit(3)),
        fn.normal_two_sided(F.lit(-1.959963984540054)),
    )
    assert got[0] == pytest.approx(math.exp(-x / 2) * (1 + x / 2))
    assert got[1] == pytest.approx(math.erfc(math.sqrt(x / 2)))
    assert got[2] == pytest.approx(
        math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    )
    assert got[3] == pytest.approx(0.05)


@pytest.mark.parametrize("a", [0.5, 1.0, 3.5, 40.0, 500.0])
def test_incomplete_gamma(spark, a):
    """Far below, around and far above the turning point, against sums of the closed forms."""
    for x in (a / 50, a * 0.9, a + 0.5, a + 1.5, a * 2 + 3):
        got, log_gamma = _one(spark, fn.upper_gamma(F.lit(a), F.lit(x)), fn.log_gamma(F.lit(a)))
        if a % 1:
            want = math.erfc(math.sqrt(x))
            start = 0.5
        else:
            want, start = 0.0, 0.0
        want += sum(math.exp(k * math.log(x) - x - math.lgamma(k + 1)) for k in [start + j for j in range(int(a - start))])
        assert got == pytest.approx(want, rel=1e-9, abs=1e-14)
        assert log_gamma == pytest.approx(math.lgamma(a), rel=1e-12, abs=1e-12)


def test_tails_of_nothing(spark):
    none = F.lit(None).cast("double")
    got = _one(spark, fn.upper_gamma(none, F.lit(1.0)), fn.upper_gamma(F.lit(2.0), none), fn.normal_two_sided(none), fn.normal_cdf(F.lit(0.0)))
    assert got == (None, None, None, 0.5)


def test_haversine(spark):
    quarter = fn.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    poles = fn.haversine(F.lit(90.0), F.lit(0.0), F.lit(-90.0), F.lit(0.0))
    same = fn.haversine(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0))
    got = _one(spark, quarter, poles, same)
    assert got == pytest.approx((6371 * math.pi / 2, 6371 * math.pi, 0.0))
