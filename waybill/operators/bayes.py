"""Bayes' rule, odds and two-by-two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import log_choose, normal_two_sided, safe_ratio


def posterior_from_data(
    df: DataFrame, hypothesis: Column, evidence: Column, given: Column | None = None
) -> DataFrame:
    """P(H | E) by Bayes' rule from its parts, next to the direct conditional mean.

    With ``given`` everything is conditional on that predicate. One aggregate.
    """
    data = df if given is None else df.where(given)
    n, h = F.count(F.lit(1)), F.count_if(hypothesis)
    e, both = F.count_if(evidence), F.count_if(hypothesis & evidence)
    miss = F.count_if(~hypothesis & evidence)
    parts = data.agg(
        n.alias("n"),
        safe_ratio(h, n).alias("prior"),
        safe_ratio(both, h).alias("p_e_given_h"),
        safe_ratio(miss, n - h).alias("p_e_given_not_h"),
        safe_ratio(e, n).alias("p_e"),
        safe_ratio(both, e).alias("direct"),
    )
    return parts.withColumn(
        "posterior", safe_ratio(F.col("p_e_given_h") * F.col("prior"), "p_e")
    )


def posterior(prior: Column, p_e_h: Column, p_e_not_h: Column) -> Column:
    """P(H | E) from the prior and both likelihoods."""
    return F.try_divide(p_e_h * prior, p_e_h * prior + p_e_not_h * (1 - prior))


def posterior_grid(df: DataFrame, prior: str, p_e_h: str, p_e_not_h: str) -> DataFrame:
    """Posterior and posterior odds for every row of a frame of priors and likelihoods."""
    p = posterior(F.col(prior), F.col(p_e_h), F.col(p_e_not_h))
    return df.withColumn("posterior", p).withColumn(
        "posterior_odds", F.try_divide(F.col("posterior"), 1 - F.col("posterior"))
    )


def largest_prior_below(grid: DataFrame, prior: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Largest prior whose posterior is still below ``threshold``; NULL if none is."""
    return grid.groupBy(*by).agg(
        F.max(F.when(F.col("posterior") < threshold, F.col(prior))).alias("largest_prior")
    )


def update_odds(
    evidence: DataFrame, key: Sequence[str], prior_odds: str, likelihood_ratio: str
) -> DataFrame:
    """Posterior odds after all pieces of evidence of a key.

    Pieces are taken as conditionally independent; their log likelihood ratios
    add up, so the order does not matter and partial sums combine.
    """
    return (
        evidence.groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("pieces"),
            F.max(prior_odds).alias("prior_odds"),
            F.sum(F.ln(F.col(likelihood_ratio))).alias("_log"),
        )
        .withColumn("posterior_odds", F.col("prior_odds") * F.exp("_log"))
        .withColumn("posterior", F.col("posterior_odds") / (1 + F.col("posterior_odds")))
        .drop("_log")
    )


def most_probable_class(df: DataFrame, cls: str, evidence: Sequence[str] = ()) -> DataFrame:
    """Most frequent class, overall or per value of the evidence, and its probability.

    Ties go to the class that sorts last.
    """
    keys = list(evidence)
    counts = df.where(F.col(cls).isNotNull()).groupBy(*keys, cls).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(
        F.max_by(cls, F.struct("n", cls)).alias("best_class"),
        safe_ratio(F.max("n"), F.sum("n")).alias("probability"),
    )


def two_by_two(df: DataFrame, exposure: Column, outcome: Column, by: Sequence[str] = ()) -> DataFrame:
    """The four cells of a table as ``a`` (both) ``b`` (exposed only) ``c`` ``d``."""
    return df.groupBy(*by).agg(
        F.count_if(exposure & outcome).alias("a"),
        F.count_if(exposure & ~outcome).alias("b"),
        F.count_if(~exposure & outcome).alias("c"),
        F.count_if(~exposure & ~outcome).alias("d"),
    )


def odds_table(cells: DataFrame) -> DataFrame:
    """Odds, log odds, odds ratio, log odds ratio and relative risk of 2x2 cells."""
    a, b, c, d = (F.col(x).cast("double") for x in "abcd")
    exposed, other = F.try_divide(a, b), F.try_divide(c, d)
    return cells.withColumns(
        {
            "odds_exposed": exposed,
            "odds_unexposed": other,
            "log_odds_exposed": F.ln(exposed),
            "log_odds_unexposed": F.ln(other),
            "odds_ratio": F.try_divide(exposed, other),
            "log_odds_ratio": F.ln(F.try_divide(exposed, other)),
            "relative_risk": F.try_divide(F.try_divide(a, a + b), F.try_divide(c, c + d)),
        }
    )


def wald_log_odds_ratio(cells: DataFrame) -> DataFrame:
    """Wald test of a zero log odds ratio: standard error, z and two-sided p."""
    parts = odds_table(cells)
    se = F.sqrt(sum(F.try_divide(F.lit(1.0), F.col(x).cast("double")) for x in "abcd"))
    z = F.col("log_odds_ratio") / se
    keep = [c for c in cells.columns]
    return parts.select(
        *keep, "log_odds_ratio", se.alias("std_error"), z.alias("z")
    ).withColumn("p_value", normal_two_sided("z"))


def hypergeom_tail(cells: DataFrame, block: int = 100_000) -> DataFrame:
    """One-sided tail P(X >= a) of 2x2 cells with all margins fixed.

    The terms are generated in blocks, so a long tail is spread over tasks and
    no array holds all of them.
    """
    keys = [c for c in cells.columns if c not in ("a", "b", "c", "d")]
    sized = cells.select(
        *keys,
        "a",
        (F.col("a") + F.col("b") + F.col("c") + F.col("d")).alias("population"),
        (F.col("a") + F.col("c")).alias("successes"),
        (F.col("a") + F.col("b")).alias("draws"),
    ).withColumn("_top", F.least("successes", "draws"))
    starts = sized.withColumn(
        "_from", F.explode(F.sequence("a", "_top", F.lit(block).cast("long")))
    )
    terms = starts.repartition("_from").withColumn(
        "_k", F.explode(F.sequence("_from", F.least(F.col("_from") + block - 1, F.col("_top"))))
    )
    log_p = (
        log_choose("successes", "_k")
        + log_choose(F.col("population") - F.col("successes"), F.col("draws") - F.col("_k"))
        - log_choose("population", "draws")
    )
    return terms.groupBy(*keys, "a", "population", "successes", "draws").agg(
        F.sum(F.coalesce(F.exp(log_p), F.lit(0.0))).alias("tail")
    )
