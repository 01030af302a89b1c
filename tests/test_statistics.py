"""Golden numbers and pairs of ways that must agree."""

import math
import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import (
    bayes,
    contingency,
    distributions,
    frames,
    geo,
    quality,
    simpson,
    survival,
)


def test_posterior_golden(frame):
    # Prior 0.3 with likelihoods 0.1 and 0.9: 0.03 / 0.66.
    grid = frame("p double, a double, b double", [(0.3, 0.1, 0.9), (0.0, 0.1, 0.9), (0.5, 0.0, 0.0)])
    got = {r.p: r for r in bayes.posterior_grid(grid, "p", "a", "b").collect()}
    assert got[0.3].posterior == pytest.approx(0.03 / 0.66)
    assert got[0.3].posterior_odds == pytest.approx(1 / 21)
    assert got[0.0].posterior == 0.0
    assert got[0.5].posterior is None


def test_odds_update_golden(frame):
    # Odds 3:7 times 1/9 is 1:21; a second piece of evidence of 3/7 gives 1:49.
    evidence = frame("k string, o double, r double", [("x", 3 / 7, 1 / 9), ("x", 3 / 7, 3 / 7)])
    got = bayes.update_odds(evidence, ["k"], "o", "r").collect()[0]
    assert got.posterior_odds == pytest.approx(1 / 49)


def test_largest_prior_below_threshold(spark):
    grid = spark.range(0, 31).select((F.col("id") / 100).alias("p"))
    grid = grid.withColumns({"a": F.lit(0.1), "b": F.lit(0.9)})
    got = bayes.largest_prior_below(bayes.posterior_grid(grid, "p", "a", "b"), "p", 0.02)
    assert got.collect()[0].largest_prior == pytest.approx(0.15)
    none = bayes.largest_prior_below(bayes.posterior_grid(grid, "p", "a", "b"), "p", 0.0)
    assert none.collect()[0].largest_prior is None


def test_posterior_two_ways(frame):
    rng = random.Random(1)
    rows = [(rng.random() < 0.3, rng.random() < 0.6, rng.random() < 0.5) for _ in range(500)]
    df = frame("h boolean, e boolean, g boolean", rows)
    got = bayes.posterior_from_data(df, F.col("h"), F.col("e"), F.col("g")).collect()[0]
    assert got.posterior == pytest.approx(got.direct)


def test_most_probable_class_counts_margin(frame):
    # Ocean 30/30, Air 8/32 (not lane / lane).
    rows = [("Ocean", "other")] * 30 + [("Ocean", "lane")] * 30
    rows += [("Air", "other")] * 8 + [("Air", "lane")] * 32
    df = frame("mode string, lane string", rows)
    assert bayes.most_probable_class(df, "mode").collect()[0].best_class == "Ocean"
    given = {r.lane: r.best_class for r in bayes.most_probable_class(df, "mode", ["lane"]).collect()}
    assert given == {"other": "Ocean", "lane": "Air"}


def test_crosstab_fills_zero_cells_and_drops_nulls(frame, rows):
    df = frame("a string, b string", [("x", "p"), ("x", "p"), ("y", "q"), (None, "p"), ("x", None)])
    assert rows(contingency.crosstab(df, "a", "b")) == [
        ("x", "p", 2),
        ("x", "q", 0),
        ("y", "p", 0),
        ("y", "q", 1),
    ]
    margins = contingency.crosstab(df, "a", "b", margins=True)
    assert ("All", "All", 3) in rows(margins)
    assert ("x", "All", 2) in rows(margins) and ("All", "q", 1) in rows(margins)


def test_chi2_by_hand_and_with_zero_cell(frame):
    table = {("a", "p"): 20, ("a", "q"): 30, ("b", "p"): 25, ("b", "q"): 25, ("c", "p"): 10}
    df = frame("x string, y string", [k for k, n in table.items() for _ in range(n)])
    n = sum(table.values())
    row = {r: sum(v for (a, _), v in table.items() if a == r) for r in "abc"}
    col = {c: sum(v for (_, b), v in table.items() if b == c) for c in "pq"}
    want = sum(
        (table.get((a, b), 0) - row[a] * col[b] / n) ** 2 / (row[a] * col[b] / n)
        for a in row
        for b in col
    )
    got = contingency.chi2_independence(df, "x", "y").collect()[0]
    assert got.chi2 == pytest.approx(want)
    assert (got.dof, got.n) == (2, n)
    assert got.p_value == pytest.approx(math.exp(-want / 2))


def test_chi2_against_ml(frame):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    rng = random.Random(3)
    df = frame("x double, y double", [(float(rng.randrange(3)), float(rng.randrange(4))) for _ in range(400)])
    data = VectorAssembler(inputCols=["x"], outputCol="f").transform(df)
    want = ChiSquareTest.test(data, "f", "y", flatten=True).collect()[0]
    got = contingency.chi2_independence(df, "x", "y").collect()[0]
    assert got.chi2 == pytest.approx(want.statistic)
    assert got.p_value == pytest.approx(want.pValue)


def test_total_probability_agrees(frame):
    rng = random.Random(2)
    df = frame("e boolean, g int", [(rng.random() < 0.4, rng.randrange(5)) for _ in range(300)])
    got = contingency.total_probability(df, F.col("e"), "g").collect()[0]
    assert got.direct == pytest.approx(got.by_parts)


def test_hypergeometric_tail_golden(frame):
    # 60 white and 60 black, 66 drawn, at least 57 white.
    cells = frame("a long, b long, c long, d long", [(57, 9, 3, 51)])
    want = sum(math.comb(60, k) * math.comb(60, 66 - k) for k in range(57, 61)) / math.comb(120, 66)
    for block in (1, 3, 100):
        got = bayes.hypergeom_tail(cells, block).collect()[0]
        assert got.tail == pytest.approx(want, rel=1e-9)


def test_hypergeometric_distribution_sums_to_one(frame):
    params = frame("big long, good long, n long", [(50, 20, 10), (30, 28, 15)])
    got = distributions.hypergeometric(params, ["big"], "big", "good", "n")
    for row in got.groupBy("big").agg(F.sum("pmf").alias("s"), F.min("x").alias("lo")).collect():
        assert row.s == pytest.approx(1.0)
        assert row.lo == (0 if row.big == 50 else 13)


def test_binomial_edges(frame):
    params = frame("k string, n int, p double", [("zero", 4, 0.0), ("one", 4, 1.0)])
    got = {
        (r.k, r.x): r.pmf for r in distributions.binomial(params, ["k"], "n", "p").collect()
    }
    assert got["zero", 0] == 1.0 and got["zero", 1] == 0.0
    assert got["one", 4] == 1.0 and got["one", 3] == 0.0


def test_claims_golden(frame):
    observed = frame("k string, hits long, n long", [("all", 30, 30000)])
    rates = frame("k string, rate double", [("all", 0.005), ("all", 0.001), ("all", 0.25)])
    got = distributions.claims_likelihood(observed, "hits", "n", rates, "rate", "k")
    best = max(got.collect(), key=lambda r: r.log_likelihood)
    assert best.rate == 0.001
    assert math.exp(best.log_likelihood) == pytest.approx(0.0727, abs=2e-4)


def test_simpson_reversal_and_golden_totals(frame, rows):
    # Fatalities / confirmed of two groups in two strata: better in both, worse overall.
    df = frame(
        "g string, s string, num long, den long",
        [
            ("a", "young", 1, 100),
            ("a", "old", 80, 400),
            ("b", "young", 8, 400),
            ("b", "old", 25, 100),
        ],
    )
    counts = simpson.stratum_counts(df, "g", "s", F.col("num"), F.col("den"))
    got = simpson.reversals(counts, "g", "s", "b").collect()[0]
    assert got.reversed and got.strata == 2
    assert got.overall_difference == pytest.approx(81 / 500 - 33 / 500)
    total = {r.g: r.total_rate for r in simpson.standardised_rate(counts, "g", "s").collect()}
    assert total == pytest.approx({"a": 81 / 500, "b": 33 / 500})
    mixed = {r.g: r.reweighted_rate for r in simpson.reweighted_rate(counts, "g", "s", "b").collect()}
    assert mixed["b"] == pytest.approx(33 / 500)
    assert mixed["a"] == pytest.approx((0.01 * 400 + 0.2 * 100) / 500)


def test_no_reversal_with_equal_stratum(frame):
    df = frame("g string, s string, num long, den long", [("a", "x", 1, 10), ("b", "x", 1, 10)])
    counts = simpson.stratum_counts(df, "g", "s", F.col("num"), F.col("den"))
    assert simpson.reversals(counts, "g", "s", "b").collect()[0].reversed is False


def test_kaplan_meier_by_hand(frame):
    df = frame(
        "t int, e boolean",
        [(1, True), (2, True), (2, False), (3, True), (4, False), (5, True)],
    )
    curve = {r.t: r for r in survival.kaplan_meier(df, "t", F.col("e")).collect()}
    s1 = 5 / 6
    s2 = s1 * 4 / 5
    s3 = s2 * 2 / 3
    assert [curve[t].survival for t in (1, 2, 3, 4)] == pytest.approx([s1, s2, s3, s3])
    assert curve[5].survival == 0.0
    assert [curve[t].at_risk for t in (1, 2, 3, 4, 5)] == [6, 5, 3, 2, 1]
    assert survival.median_survival(survival.kaplan_meier(df, "t", F.col("e"))).collect()[0][0] == 3


def test_median_survival_never_reached(frame):
    df = frame("t int, e boolean", [(1, True), (9, False), (9, False), (9, False)])
    curve = survival.kaplan_meier(df, "t", F.col("e"))
    assert survival.median_survival(curve).collect()[0].median_t is None


def test_geometric_mle_is_the_grid_maximum(frame):
    rng = random.Random(8)
    data = [(rng.randrange(0, 30), rng.random() < 0.7) for _ in range(200)]
    got = survival.geometric_mle(frame("t int, e boolean", data), "t", F.col("e")).collect()[0]

    def loss(p):
        return -sum(
            math.log(p) + (t - 1) * math.log(1 - p) if e else t * math.log(1 - p)
            for t, e in data
            if t > 0
        )

    best = min((loss(i / 10000), i / 10000) for i in range(1, 3000))[1]
    assert got.p_hat == pytest.approx(best, abs=1e-4)


def test_memoryless_on_geometric_counts(frame):
    # Halving counts: survival 1/2 per step, so the property holds up to the cut-off.
    df = frame("t int", [(t,) for t in range(12) for _ in range(2 ** (11 - t))])
    got = {(r.s, r.t): r for r in survival.memoryless(df, "t", [0, 1, 2, 3]).collect()}
    assert got[1, 2].given_survived_t == pytest.approx(got[1, 2].from_start, abs=2e-3)
    assert got[0, 3].given_survived_t == 1.0


def test_empirical_and_lotus(frame, rows):
    df = frame("x double", [(1.0,), (1.0,), (4.0,), (None,)])
    assert rows(distributions.empirical(df, "x")) == [
        (1.0, 2, pytest.approx(2 / 3), pytest.approx(2 / 3)),
        (4.0, 1, pytest.approx(1 / 3), 1.0),
    ]
    got = distributions.lotus(df, "x", lambda c: c * c).collect()[0]
    assert got.from_pmf == pytest.approx(got.direct) == pytest.approx(6.0)


def test_histogram_edges(frame):
    df = frame("x double", [(0.0,), (1.0,), (2.0,), (4.0,), (None,)])
    got = {r.bin: r for r in quality.histogram(df, "x", 4).collect()}
    assert [got[i].n for i in range(4)] == [1, 1, 1, 1]  # the last edge is closed
    assert got[3].cumulative == 1.0
    assert sum(got[i].density for i in range(4)) == pytest.approx(1.0)
    constant = quality.histogram(frame("x double", [(3.0,), (3.0,)]), "x", 2).collect()
    assert sorted((r.bin, r.n, r.left_edge) for r in constant) == [(0, 0, 2.5), (1, 2, 3.0)]


def test_poisson_counts_fill_empty_hours(frame, rows):
    df = frame("s string", [("2024-01-01 00:10:00",), ("2024-01-01 00:50:00",), ("2024-01-01 03:00:00",)])
    df = df.select(F.col("s").cast("timestamp_ntz").alias("ts"))
    counts = distributions.interval_counts(df, "ts")
    assert sorted(r.n for r in counts.collect()) == [0, 0, 1, 2]
    fit = {r.x: r for r in distributions.poisson_fit(counts).collect()}
    assert fit[0].observed == 0.5
    assert fit[1].poisson == pytest.approx(0.75 * math.exp(-0.75))


def test_sampling_distribution(spark):
    df = spark.range(5000).withColumn("flag", F.col("id") % 5 == 0)
    got = distributions.sampling_distribution(df, ["id"], F.col("flag"), 40, 200, seed=3).collect()
    assert len(got) == 200 and all(r.drawn == 40 for r in got)
    mean = sum(r.successes for r in got) / 200
    assert mean == pytest.approx(8.0, abs=0.7)
    variance = sum((r.successes - mean) ** 2 for r in got) / 199
    assert variance == pytest.approx(40 * 0.2 * 0.8 * (1 - 40 / 5000), rel=0.35)
    tiny = distributions.sampling_distribution(df.limit(10), ["id"], F.col("flag"), 4, 5).collect()
    assert all(r.drawn == 4 for r in tiny)


def test_frequencies_ignore_nulls(frame, rows):
    df = frame("v string", [("a",), ("a",), ("b",), (None,)])
    assert rows(quality.frequencies(df, "v")) == [
        ("a", 2, pytest.approx(2 / 3)),
        ("b", 1, pytest.approx(1 / 3)),
    ]


def test_describe_and_profiles(frame):
    df = frame("k int, v double", [(1, 1.0), (2, 2.0), (3, 4.0), (4, None)])
    got = {r.column_name: r for r in quality.describe(df, ["k", "v"]).collect()}
    assert (got["v"]["count"], got["v"].q50, got["v"].q75) == (3, 2.0, 3.0)
    assert got["v"].std == pytest.approx(math.sqrt(7 / 3))
    nulls = {r.column_name: r for r in quality.null_profile(df).collect()}
    assert nulls["v"].null_fraction == 0.25 and nulls["v"].has_nulls and not nulls["k"].has_nulls
    top = quality.grain(df.unionByName(df.where("k = 1")), ["k"]).first()
    assert (top.k, top.n) == (1, 2)


def test_argmax_keeps_ties(frame, rows):
    df = frame("k string, v int", [("a", 3), ("a", 3), ("b", 1), ("c", None)])
    assert rows(frames.argmax_rows(df, "v")) == [("a", 3), ("a", 3)]
    assert rows(frames.argmax_rows(df, "v", ["k"])) == [("a", 3), ("a", 3), ("b", 1)]


def test_dedup_first(frame, rows):
    df = frame("k string, t int, id int, v string", [("a", 2, 1, "x"), ("a", 1, 3, None), ("a", 1, 2, "z")])
    assert rows(frames.dedup_first(df, ["k"], ["t", "id"])) == [("a", 1, 2, "z")]


def test_levels_come_from_the_data(frame, rows):
    df = frame("k string, v int", [("b", 1), (None, 2), ("a", 3), ("b", 4)])
    assert frames.levels_of(df, "k") == ["a", "b"]
    assert frames.unstack(df, [], "k", None, F.sum("v")).collect()[0].asDict() == {"a": 3, "b": 5}


def test_nearest_is_independent_of_blocks(frame, rows):
    rng = random.Random(4)
    sites = frame(
        "site string, lat double, lon double",
        [(f"s{i:02d}", rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(30)],
    )
    points = frame(
        "id int, lat double, lon double",
        [(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(40)],
    )
    one = rows(geo.nearest(points, sites, "id", "site"))
    many = rows(geo.nearest(points, sites, "id", "site", block=4))
    assert one == many and len(one) == 40
    matrix = geo.distance_matrix(sites, "site", block=7)
    assert matrix.count() == 30 * 29
    ab = matrix.where("site_a = 's00' AND site_b = 's07'").first().km
    ba = matrix.where("site_a = 's07' AND site_b = 's00'").first().km
    assert ab == pytest.approx(ba)


def test_nearest_by_boxes_equals_all_distances(spark):
    """A dense town, the poles, the date line and equal places; boxes within boxes."""
    rng = random.Random(8)
    town = [(f"t{i:04d}", 48.0 + rng.random() / 50, 11.0 + rng.random() / 50) for i in range(600)]
    wide = [(f"w{i:03d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    odd = [("n1", 90.0, 0.0), ("n0", 90.0, 0.0), ("d1", 0.0, 179.9), ("d2", 0.0, -179.9), ("none", None, 1.0)]
    places = town + wide + odd
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    points += [(200 + i, 48.0 + rng.random() / 40, 11.0 + rng.random() / 40) for i in range(50)]
    points += [(300, 90.0, 45.0), (301, 0.0, 180.0), (302, None, 0.0)]
    schema = "id long, lat double, lon double"
    p = spark.createDataFrame(points, schema)
    s = spark.createDataFrame(places, "site string, lat double, lon double")
    plain = geo.nearest(p, s, "id", "site", block=5000)
    assert plain.count() == len(points) - 1
    want = {r["id"]: (r["nearest_site"], r["km"]) for r in plain.collect()}
    for block in (40, 200):
        got = {r["id"]: (r["nearest_site"], r["km"]) for r in geo.nearest(p, s, "id", "site", block=block).collect()}
        assert got == want
    assert want[300][0] == "n0" and want[301][0] == "d1"


def test_nearest_without_sites(frame):
    none = frame("site string, lat double, lon double", [])
    assert geo.nearest(frame("id long, lat double, lon double", [(1, 0.0, 0.0)]), none, "id", "site").count() == 0


def test_sparse_chi2_equals_the_full_grid(spark):
    """Many levels, few observed cells: no grid is needed for the statistic."""
    rng = random.Random(12)
    pairs = [(f"a{rng.randrange(60)}", f"b{rng.randrange(50)}") for _ in range(700)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = contingency.chi2_independence(df, "a", "b").collect()[0]
    full = contingency.expected(df, "a", "b").collect()
    want = sum(r.residual**2 / r.expected for r in full)
    assert got.chi2 == pytest.approx(want, rel=1e-9)
    assert got.n == 700 and got.dof == (len({a for a, _ in pairs}) - 1) * (len({b for _, b in pairs}) - 1)
    assert len(full) == len({a for a, _ in pairs}) * len({b for _, b in pairs})


def test_grid_in_blocks_of_levels(spark, monkeypatch, rows):
    df = spark.createDataFrame([(f"a{i % 3}", f"b{i % 7}") for i in range(30)], "a string, b string")
    whole = rows(contingency.crosstab(df, "a", "b"))
    monkeypatch.setattr(contingency, "LEVEL_BLOCK", 2)
    assert rows(contingency.crosstab(df, "a", "b")) == whole and len(whole) == 21


def test_supports_in_blocks(frame, rows):
    params = frame("k int, n int, p double", [(1, 60, 0.3), (2, 7, 0.9), (3, 0, 0.5)])
    keys = ["k"]
    whole = distributions.binomial(params, keys, "n", "p").orderBy("k", "x").collect()
    blocks = distributions.binomial(params, keys, "n", "p", block=4).orderBy("k", "x").collect()
    assert len(whole) == len(blocks) == 61 + 8 + 1
    for a, b in zip(whole, blocks):
        assert (a.k, a.x) == (b.k, b.x)
        assert (a.cdf, a.tail) == (pytest.approx(b.cdf), pytest.approx(b.tail))
    last = [r for r in blocks if r.k == 1][-1]
    assert last.cdf == pytest.approx(1.0) and last.tail == pytest.approx(0.3**60, rel=1e-9)


def test_category_shares(frame, rows):
    df = frame("e string, c string", [("x", "usd"), ("x", "eur"), ("y", "usd"), (None, "usd")])
    assert rows(quality.category_shares(df, ["e", "c"])) == sorted(
        [("e", "x", 2, 0.5), ("e", "y", 1, 0.25), ("e", None, 1, 0.25), ("c", "usd", 3, 0.75), ("c", "eur", 1, 0.25)], key=repr
    )


def test_likelihood_fits_find_the_maximum(spark):
    """Small steps away from the fitted parameters make the data less likely."""
    rng = random.Random(21)
    data = [(rng.gammavariate(2.5, 3.0), rng.betavariate(2.0, 5.0), rng.weibullvariate(4.0, 1.7)) for _ in range(4000)]
    df = spark.createDataFrame([*data, (None, None, None), (0.0, 0.0, -1.0), (-3.0, 1.0, 0.0)], "g double, b double, w double")

    def total(log_pdf, values):
        return sum(log_pdf(x) for x in values)

    g = distributions.gamma_fit(df, "g").first()
    like = lambda k, s: total(lambda x: (k - 1) * math.log(x) - x / s - k * math.log(s) - math.lgamma(k), [r[0] for r in data])
    assert g.n == 4000 and g.log_likelihood == pytest.approx(like(g.shape, g.scale), rel=1e-9)
    for d in (-1e-3, 1e-3):
        assert like(g.shape * (1 + d), g.scale) < g.log_likelihood > like(g.shape, g.scale * (1 + d))
    b = distributions.beta_fit(df, "b").first()
    const = lambda a, c: math.lgamma(a + c) - math.lgamma(a) - math.lgamma(c)
    like = lambda a, c: total(lambda x: (a - 1) * math.log(x) + (c - 1) * math.log(1 - x) + const(a, c), [r[1] for r in data])
    assert b.n == 4000 and b.log_likelihood == pytest.approx(like(b.a, b.b), rel=1e-9)
    for d in (-1e-3, 1e-3):
        assert like(b.a * (1 + d), b.b) < b.log_likelihood > like(b.a, b.b * (1 + d))
    w = distributions.weibull_fit(df, "w").first()
    like = lambda k, s: total(lambda x: math.log(k / s) + (k - 1) * math.log(x / s) - (x / s) ** k, [r[2] for r in data])
    assert w.n == 4000 and w.log_likelihood == pytest.approx(like(w.shape, w.scale), rel=1e-9)
    for d in (-1e-3, 1e-3):
        assert like(w.shape * (1 + d), w.scale) < w.log_likelihood > like(w.shape, w.scale * (1 + d))


def test_likelihood_fits_of_constant_and_empty_columns(frame):
    same = frame("x double", [(0.5,), (0.5,)])
    none = frame("x double", [])
    for df, n in ((same, 2), (none, 0)):
        assert distributions.gamma_fit(df, "x").first()[:2] == (n, None)
        assert distributions.beta_fit(df, "x").first()[:2] == (n, None)
        assert distributions.weibull_fit(df, "x").first()[:2] == (n, None)
