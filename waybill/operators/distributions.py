"""Empirical and named distributions, moments and fits."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import digamma, log_choose, log_factorial, log_gamma, safe_ratio, trigamma
from waybill.operators.ordered import running_totals
from waybill.operators.quality import histogram
from waybill.operators.staging import one_row, staged
from waybill.sources import from_rows


def empirical(df: DataFrame, column: str) -> DataFrame:
    """``(x, n, pmf, cdf)`` of a numeric column, NULLs ignored."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    summed = running_totals(counts, [], ["x"], {"_cum": F.col("n")})
    return summed.select(
        "x", "n", safe_ratio("n", total).alias("pmf"), safe_ratio("_cum", total).alias("cdf")
    )


def bernoulli(df: DataFrame, flag: Column, by: Sequence[str] = ()) -> DataFrame:
    """Estimated p and q = 1 - p of a boolean."""
    p = F.avg(flag.cast("double"))
    return df.groupBy(*by).agg(F.count(flag).alias("n"), p.alias("p"), (1 - p).alias("q"))


def _support(params: DataFrame, low: Column, high: Column, block: int = 100_000) -> DataFrame:
    """One row per whole number from low to high; generated in blocks, so that no array holds a long support."""
    starts = params.withColumns({"_high": high, "_from": low}).withColumn(
        "_from", F.explode(F.sequence("_from", "_high", F.lit(block).cast("long")))
    )
    end = F.least(F.col("_from") + (block - 1), F.col("_high"))
    return starts.withColumn("x", F.explode(F.sequence("_from", end))).withColumnRenamed("_from", "_block").drop("_high")


def _cumulate(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add cdf and tail, whatever the length of a support.

    A window works inside a block of the support; the sums of the blocks before it, a few numbers for each
    parameter set, are joined to it. The tail is summed from its own end, so that small ones keep their digits.
    """
    inside = Window.partitionBy(*keys, "_block")
    up = inside.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    down = inside.orderBy("x").rowsBetween(0, Window.unboundedFollowing)
    across = Window.partitionBy(*keys).orderBy("_block")
    blocks = frame.groupBy(*keys, "_block").agg(F.sum("pmf").alias("_sum"))
    carried = blocks.select(
        *keys,
        "_block",
        F.coalesce(F.sum("_sum").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_below"),
        F.coalesce(F.sum("_sum").over(across.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0)).alias("_above"),
    )
    local = frame.withColumns({"cdf": F.sum("pmf").over(up), "tail": F.sum("pmf").over(down)})
    columns = [c for c in frame.columns if c != "_block"]
    return local.join(carried, [*keys, "_block"]).select(
        *columns, (F.col("cdf") + F.col("_below")).alias("cdf"), (F.col("tail") + F.col("_above")).alias("tail")
    )


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x == 0, 0.0).otherwise(x * F.ln(y))


def binomial_log_pmf(k: Column, n: Column, p: Column) -> Column:
    return log_choose(n, k) + _xlogy(k, p) + _xlogy(n - k, 1 - p)


def binomial(params: DataFrame, keys: Sequence[str], n: str, p: str, block: int = 100_000) -> DataFrame:
    """PMF, CDF and P(X >= x) over 0..n for each row of ``params``."""
    grid = _support(params, F.lit(0).cast("long"), F.col(n).cast("long"), block)
    pmf = F.coalesce(F.exp(binomial_log_pmf(F.col("x"), F.col(n), F.col(p))), F.lit(0.0))
    return _cumulate(grid.withColumn("pmf", pmf), keys)


def hypergeometric(
    params: DataFrame, keys: Sequence[str], population: str, successes: str, draws: str
) -> DataFrame:
    """PMF, CDF and P(X >= x) of draws without replacement."""
    big, good, n = (F.col(c).cast("long") for c in (population, successes, draws))
    grid = _support(params, F.greatest(F.lit(0).cast("long"), n - (big - good)), F.least(n, good))
    log_p = log_choose(good, F.col("x")) + log_choose(big - good, n - F.col("x")) - log_choose(big, n)
    return _cumulate(grid.withColumn("pmf", F.exp(log_p)), keys)


def geometric(params: DataFrame, keys: Sequence[str], p: str, up_to: int, first_success: bool = True) -> DataFrame:
    """PMF, CDF and survival P(X > x) of the number of trials.

    ``first_success`` counts the successful trial (support from 1), otherwise the
    failures before it (support from 0).
    """
    shift = 1 if first_success else 0
    grid = _support(params, F.lit(shift).cast("long"), F.lit(up_to).cast("long")).drop("_block")
    q, k = 1 - F.col(p), F.col("x") - shift
    survival = F.pow(q, (k + 1).cast("double"))
    return grid.withColumns(
        {
            "pmf": F.col(p) * F.pow(q, k.cast("double")),
            "cdf": 1 - survival,
            "survival": survival,
        }
    )


def poisson_pmf(k: Column, rate: Column) -> Column:
    return F.exp(_xlogy(k.cast("double"), rate) - rate - log_factorial(k))


def interval_counts(df: DataFrame, ts: str, unit: str = "hour") -> DataFrame:
    """Events per ``unit`` between the first and last event, empty units included."""
    per_day = {"hour": 24, "day": 1}[unit]
    day = F.unix_date(F.col(ts).cast("date")).cast("long") * per_day
    slot = day + F.hour(ts) if unit == "hour" else day
    counts = staged(
        df.where(F.col(ts).isNotNull())
        .groupBy(slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    span = counts.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).where("lo IS NOT NULL")
    grid = _support(span, F.col("lo"), F.col("hi")).select(F.col("x").alias("slot"))
    return grid.join(counts, "slot", "left").select("slot", F.coalesce("n", F.lit(0)).alias("n"))


def poisson_fit(counts: DataFrame, column: str = "n") -> DataFrame:
    """Observed share of each count against the Poisson with the same mean.

    ``dispersion`` (variance over mean) is near 1 for Poisson data.
    """
    by_count = counts.groupBy(F.col(column).alias("x")).agg(F.count(F.lit(1)).alias("intervals"))
    facts = counts.agg(
        F.avg(column).alias("rate"),
        safe_ratio(F.var_samp(column), F.avg(column)).alias("dispersion"),
        F.count(F.lit(1)).alias("total"),
    )
    return by_count.withColumn("_f", one_row(facts)).select(
        "x",
        "intervals",
        safe_ratio("intervals", "_f.total").alias("observed"),
        poisson_pmf(F.col("x"), F.col("_f.rate")).alias("poisson"),
        "_f.rate",
        "_f.dispersion",
    )


def claims_likelihood(observed: DataFrame, k: str, n: str, rates: DataFrame, rate: str, on: str) -> DataFrame:
    """Log-likelihood of k successes in n trials under each candidate rate of its key."""
    log_l = binomial_log_pmf(F.col(k), F.col(n), F.col(rate))
    return observed.join(rates, on).withColumn("log_likelihood", log_l)


def moments(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, variance (n and n-1), skewness and excess kurtosis (population forms)."""
    return df.groupBy(*by).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.var_pop(column).alias("var_pop"),
        F.var_samp(column).alias("var_samp"),
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
    )


def mean_absolute_deviation(df: DataFrame, column: str) -> DataFrame:
    """Mean distance to the mean: the mean first, then one pass over the data."""
    mean = df.agg(F.avg(column)).scalar()
    return df.agg(
        F.count(column).alias("n"), F.avg(F.abs(F.col(column) - mean)).alias("mean_abs_deviation")
    )


def _normal_pdf(x: Column, mean: Column, std: Column) -> Column:
    z = (x - mean) / std
    return F.exp(-z * z / 2) / (std * math.sqrt(2 * math.pi))


def normal_fit(df: DataFrame, column: str) -> DataFrame:
    """Normal density at whole numbers of the data's range beside the observed share there.

    The share at v counts values in [v, v + 1).
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    facts = values.agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("total")
    )
    counts = values.groupBy(F.floor("v").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    mean, std = F.col("_f.mean"), F.col("_f.std")
    return counts.withColumn("_f", one_row(facts)).select(
        "x",
        "n",
        safe_ratio("n", "_f.total").alias("observed"),
        _normal_pdf(F.col("x").cast("double"), mean, std).alias("normal_density"),
        mean.alias("mean"),
        std.alias("std"),
    )


# Fixed value: the Euler-Mascheroni constant.
EULER_GAMMA = 0.5772156649015329


def _densities(x: Column, s: Callable[[str], Column]) -> dict[str, Column]:
    """Density of each family at x with closed-form parameters from the statistics ``s``."""
    mean, std, lo, hi = s("mean"), s("std"), s("lo"), s("hi")
    exp_scale = mean - lo
    laplace = std / math.sqrt(2)
    logistic = std * math.sqrt(3) / math.pi
    gumbel = std * math.sqrt(6) / math.pi
    zl = F.exp(-F.abs((x - mean) / logistic))
    zg = (x - (mean - EULER_GAMMA * gumbel)) / gumbel
    var_r = s("mean_square") / 2
    mu, sigma = s("log_mean"), s("log_std")
    zn = (F.ln(F.when(x > 0, x)) - mu) / sigma
    shape, scale = s("shape"), s("mean") / s("shape")
    log_gamma_pdf = (shape - 1) * F.ln(x) - x / scale - shape * F.ln(scale) - log_gamma(shape)
    return {
        "gamma": F.when(lo > 0, F.when(x > 0, F.exp(log_gamma_pdf)).otherwise(0.0)),
        "normal": _normal_pdf(x, mean, std),
        "exponential": F.when(x >= lo, F.exp(-(x - lo) / exp_scale) / exp_scale).otherwise(0.0),
        "uniform": F.when((x >= lo) & (x <= hi), 1 / (hi - lo)).otherwise(0.0),
        "laplace": F.exp(-F.abs(x - mean) / laplace) / (2 * laplace),
        "logistic": zl / (logistic * (1 + zl) * (1 + zl)),
        "gumbel": F.exp(-zg - F.exp(-zg)) / gumbel,
        "rayleigh": F.when(x > 0, x / var_r * F.exp(-x * x / (2 * var_r))).otherwise(0.0),
        "lognormal": F.when(
            lo > 0,
            F.coalesce(F.exp(-zn * zn / 2) / (x * sigma * math.sqrt(2 * math.pi)), F.lit(0.0)),
        ),
    }


#: Newton steps of the likelihood equations; each squares the error, and the starts are near.
STEPS = 12


def gamma_shape(mean: Column, log_mean: Column) -> Column:
    """The gamma shape of greatest likelihood from the mean and the mean logarithm alone.

    Newton's iteration of ``ln k - digamma(k) = ln(mean) - log_mean``; NULL where all values are equal.
    """
    s = F.ln(mean) - log_mean
    start = (3 - s + F.sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s)

    def step(k: Column, _: Column) -> Column:
        return F.greatest(k - (F.ln(k) - digamma(k) - s) / (1 / k - trigamma(k)), k / 10)

    return F.when(s > 1e-14, F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step))


def gamma_fit(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Gamma shape, scale and log-likelihood per group, from one aggregate and Newton's iteration.

    Values of 0 and less, and NULLs, are left out.
    """
    x = F.when(F.col(column) > 0, F.col(column).cast("double"))
    sums = df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("_mean"), F.avg(F.ln(x)).alias("_log"))
    fitted = sums.withColumn("shape", gamma_shape(F.col("_mean"), F.col("_log"))).withColumn("scale", F.col("_mean") / F.col("shape"))
    k, theta = F.col("shape"), F.col("scale")
    likelihood = F.col("n") * ((k - 1) * F.col("_log") - k - k * F.ln(theta) - log_gamma(k))
    return fitted.select(*by, "n", "shape", "scale", likelihood.alias("log_likelihood"))


def beta_fit(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Beta parameters and log-likelihood per group of values strictly between 0 and 1.

    Newton's iteration on the mean logarithms of x and 1 - x, begun at the moments' solution.
    """
    x = F.when((F.col(column) > 0) & (F.col(column) < 1), F.col(column).cast("double"))
    sums = df.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("_mean"), F.var_pop(x).alias("_var"), F.avg(F.ln(x)).alias("_l"), F.avg(F.ln(1 - x)).alias("_r")
    )
    size = F.greatest(F.col("_mean") * (1 - F.col("_mean")) / F.col("_var") - 1, F.lit(0.1))
    start = F.struct((F.col("_mean") * size).alias("a"), ((1 - F.col("_mean")) * size).alias("b"))

    def step(s: Column, _: Column) -> Column:
        a, b = s["a"], s["b"]
        both = trigamma(a + b)
        g, h = digamma(a + b) - digamma(a) + F.col("_l"), digamma(a + b) - digamma(b) + F.col("_r")
        aa, bb = both - trigamma(a), both - trigamma(b)
        det = aa * bb - both * both
        return F.struct(
            F.greatest(a - (g * bb - h * both) / det, a / 10).alias("a"), F.greatest(b - (h * aa - g * both) / det, b / 10).alias("b")
        )

    fitted = sums.withColumn("_p", F.when(F.col("_var") > 0, F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)))
    a, b = F.col("_p.a"), F.col("_p.b")
    likelihood = F.col("n") * ((a - 1) * F.col("_l") + (b - 1) * F.col("_r") + log_gamma(a + b) - log_gamma(a) - log_gamma(b))
    return fitted.select(*by, "n", a.alias("a"), b.alias("b"), likelihood.alias("log_likelihood"))


def weibull_fit(df: DataFrame, column: str, tolerance: float = 1e-12, most_steps: int = 50) -> DataFrame:
    """Weibull shape, scale and log-likelihood of the positive values, and the passes it took.

    The shape's equation has sums of powers that change with the shape, so each Newton step is one
    aggregate over the counted values; three numbers come back from each.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x > 0")
    counts = staged(values.groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("n")))
    top = counts.agg(F.max("x")).scalar()
    scaled = staged(counts.withColumn("y", F.ln(F.col("x") / top)))
    first = scaled.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("l"), F.max("x").alias("top"), F.min("y").alias("low")).first()
    spark, schema = df.sparkSession, "n long, shape double, scale double, log_likelihood double, steps int"
    if not first["n"] or first["low"] == 0.0:
        return from_rows(spark, [(int(first["n"] or 0), None, None, None, 0)], schema)
    n, mean_log = first["n"], first["l"] / first["n"]
    k, steps, moved = 1.0, 0, math.inf
    while moved > tolerance and steps < most_steps:
        w = F.col("n") * F.exp(F.lit(k) * F.col("y"))
        s0, s1, s2 = scaled.agg(F.sum(w), F.sum(w * F.col("y")), F.sum(w * F.col("y") * F.col("y"))).first()
        value = s1 / s0 - 1 / k - mean_log
        slope = s2 / s0 - (s1 / s0) ** 2 + 1 / (k * k)
        after = max(k - value / slope, k / 4)
        moved, k, steps = abs(after - k) / k, after, steps + 1
    s0 = scaled.agg(F.sum(F.col("n") * F.exp(F.lit(k) * F.col("y")))).first()[0]
    scale = first["top"] * (s0 / n) ** (1 / k)
    logs = mean_log + math.log(first["top"])
    likelihood = n * (math.log(k) - k * math.log(scale) + (k - 1) * logs - 1)
    return from_rows(spark, [(int(n), k, scale, likelihood, steps)], schema)


def best_fit(df: DataFrame, column: str, bins: int = 200) -> DataFrame:
    """Named families ranked by squared error against the histogram density.

    Parameters come from one aggregate, in closed form or, for the gamma family, by the
    iteration for the greatest likelihood. A family that cannot hold
    the data (lognormal, gamma with non-positive values) has a NULL error and no rank.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    stats = values.agg(
        F.avg("v").alias("mean"),
        F.stddev_pop("v").alias("std"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.avg(F.col("v") * F.col("v")).alias("mean_square"),
        F.avg(F.when(F.col("v") > 0, F.ln("v"))).alias("log_mean"),
        F.stddev_pop(F.when(F.col("v") > 0, F.ln("v"))).alias("log_std"),
    )
    stats = stats.withColumn("shape", F.when(F.col("lo") > 0, gamma_shape(F.col("mean"), F.col("log_mean"))))
    shape = histogram(values, "v", bins).withColumn("_s", one_row(stats))
    fits = _densities(F.col("midpoint"), lambda name: F.col(f"_s.{name}"))
    errors = shape.select(
        *[F.pow(F.col("density") - e, F.lit(2.0)).alias(name) for name, e in fits.items()]
    ).agg(*[F.sum(name).alias(name) for name in fits])
    tall = errors.unpivot([], list(fits), "family", "sse")
    ranked = F.when(
        F.col("sse").isNotNull(), F.rank().over(Window.orderBy(F.asc_nulls_last("sse")))
    )
    return tall.withColumn("rank", ranked)


def lotus(df: DataFrame, column: str, transform: Callable[[Column], Column]) -> DataFrame:
    """Mean of a transform from the distribution of the column and directly."""
    by_value = empirical(df, column).agg(
        F.sum(transform(F.col("x")) * F.col("pmf")).alias("from_pmf")
    )
    direct = df.agg(F.avg(transform(F.col(column).cast("double")))).scalar()
    return by_value.withColumn("direct", direct)


def running_proportion(
    df: DataFrame, order: Sequence[str], flag: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Share of true values among the rows so far, along ``order``."""
    summed = running_totals(
        df,
        keys,
        order,
        {"_hits": flag.cast("long"), "trials": F.lit(1).cast("long")},
    )
    return summed.withColumn("proportion", safe_ratio("_hits", "trials")).drop("_hits")


#: Bits of the hash that orders rows, and of its prefixes that are counted.
_HASH_BITS, _PREFIX_BITS = 60, 20


def _hash(*parts: Column) -> Column:
    """The first 60 bits of the MD5 of the parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, _HASH_BITS // 4), 16, 10).cast("long")


def sampling_distribution(
    df: DataFrame, keys: Sequence[str], flag: Column, n: int, replicates: int, seed: int = 0
) -> DataFrame:
    """Successes in each of ``replicates`` seeded samples of exactly ``n`` rows without replacement.

    Every row has one hash of (seed, keys), every replicate one of (seed, its number); a replicate
    consists of the ``n`` rows whose hash differs least from its own (as numbers, after an exclusive or),
    ties by the keys. So each replicate is a uniform sample, and each row is hashed once. Rows with equal
    leading bits are counted; from these counts follows, for each replicate, the longest prefix that at
    least ``n`` rows share with it, and only these rows are ranked. A table of fewer rows is drawn whole.

    ``keys`` identify a row.
    """
    own = _hash(F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    rows = df.select(*keys, F.coalesce(flag, F.lit(False)).cast("int").alias("_hit"), own.alias("_h"))
    spark = df.sparkSession
    drawn = spark.range(1, replicates + 1).select(
        F.col("id").cast("int").alias("replicate"), _hash(F.lit(str(seed)), F.lit("replicate"), F.col("id").cast("string")).alias("_s")
    )
    cut = lambda c, bits: F.call_function("shiftright", F.col(c), bits.cast("int"))
    prefix = lambda c, bits: cut(c, F.lit(_HASH_BITS) - bits)
    depths = F.sequence(F.lit(0), F.lit(_PREFIX_BITS))
    counts = rows.groupBy(prefix("_h", F.lit(_PREFIX_BITS)).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_bits", F.explode(depths)).groupBy(
        "_bits", cut("_p", F.lit(_PREFIX_BITS) - F.col("_bits")).alias("_p")
    ).agg(F.sum("_n").alias("_n"))
    asked = drawn.withColumn("_bits", F.explode(depths)).withColumn("_p", prefix("_s", F.col("_bits")))
    enough = (F.col("_n") >= n) | (F.col("_bits") == 0)
    chosen = asked.join(counts, ["_bits", "_p"]).where(enough).groupBy("replicate", "_s").agg(F.max("_bits").alias("_bits"))
    chosen = staged(chosen.withColumn("_p", prefix("_s", F.col("_bits"))))
    used = F.array(*[F.lit(r["_bits"]) for r in chosen.select("_bits").distinct().collect()] or [F.lit(0)])
    near = rows.withColumn("_bits", F.explode(used)).withColumn("_p", prefix("_h", F.col("_bits")))
    near = near.join(F.broadcast(chosen), ["_bits", "_p"]).withColumn("_far", F.col("_h").bitwiseXOR(F.col("_s")))
    w = Window.partitionBy("replicate").orderBy("_far", *keys)
    sample = near.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n)
    return sample.groupBy("replicate").agg(
        F.count(F.lit(1)).alias("drawn"), F.sum("_hit").alias("successes")
    )
