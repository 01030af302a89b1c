"""Durations with right-censoring, in whole periods.

The event table has one row per stratum and whole period, so its ordered windows
stay small no matter how many subjects there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import safe_ratio


def event_table(df: DataFrame, t: str, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """Observed, censored and at-risk counts per whole period ``t``."""
    counts = (
        df.where(F.col(t).isNotNull())
        .groupBy(*by, F.col(t).cast("long").alias("t"))
        .agg(F.count_if(event).alias("observed"), F.count_if(~event).alias("censored"))
    )
    later = Window.partitionBy(*by).orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("at_risk", F.sum(F.col("observed") + F.col("censored")).over(later))


def kaplan_meier(df: DataFrame, t: str, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """Product-limit survival curve at every observed period."""
    table = event_table(df, t, event, by)
    upto = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    all_gone = F.max((F.col("observed") == F.col("at_risk")).cast("int")).over(upto) == 1
    step = F.when(
        F.col("observed") < F.col("at_risk"),
        F.ln(F.lit(1.0) - F.col("observed") / F.col("at_risk")),
    )
    curve = F.exp(F.coalesce(F.sum(step).over(upto), F.lit(0.0)))
    return table.withColumn("survival", F.when(all_gone, 0.0).otherwise(curve))


def median_survival(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First period with survival of one half or less; NULL if it stays above.

    The comparison allows for rounding in the product of the steps.
    """
    return curve.groupBy(*by).agg(
        F.min(F.when(F.col("survival") <= 0.5 + 1e-12, F.col("t"))).alias("median_t")
    )


def geometric_mle(df: DataFrame, t: str, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """Maximum-likelihood risk per period with right-censoring, in closed form.

    p = events / sum of durations over subjects with t > 0, with the mean and
    median lifetime it implies.
    """
    whole = F.col(t).cast("long")
    p = df.where(whole > 0).groupBy(*by).agg(
        F.count(F.lit(1)).alias("subjects"),
        F.count_if(event).alias("events"),
        F.sum(whole).alias("exposure"),
        safe_ratio(F.count_if(event), F.sum(whole)).alias("p_hat"),
    )
    return p.withColumns(
        {
            "mean_lifetime": F.try_divide(F.lit(1.0), F.col("p_hat")),
            "median_lifetime": F.when(
                (F.col("p_hat") > 0) & (F.col("p_hat") < 1),
                F.ceil(F.lit(-0.6931471805599453) / F.ln(1 - F.col("p_hat"))),
            ),
        }
    )


def fitted_curve(df: DataFrame, t: str, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """Product-limit curve beside the survival of the fitted geometric."""
    curve = kaplan_meier(df, t, event, by)
    fit = geometric_mle(df, t, event, by).select(*by, "p_hat")
    if by:
        joined = curve.join(fit, list(by), "left")
    else:
        joined = curve.withColumn("p_hat", fit.scalar())
    fitted = F.pow(1 - F.col("p_hat"), F.col("t").cast("double"))
    return joined.select(*by, "t", "survival", fitted.alias("fitted")).withColumn(
        "gap", F.col("survival") - F.col("fitted")
    )


def memoryless(df: DataFrame, t: str, steps: Sequence[int]) -> DataFrame:
    """P(X >= s + t | X >= t) against P(X >= s) for every s and t of ``steps``.

    Durations are counted once per period; the grid is built on those counts.
    """
    counts = (
        df.where(F.col(t).isNotNull())
        .groupBy(F.col(t).cast("long").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    values = F.array(*[F.lit(int(v)) for v in steps])
    grid = counts.withColumn("s", F.explode(values)).withColumn("t", F.explode(values))
    n, x, s, u = F.col("n"), F.col("x"), F.col("s"), F.col("t")
    return (
        grid.groupBy("s", "t")
        .agg(
            safe_ratio(
                F.sum(F.when(x >= s + u, n).otherwise(0)), F.sum(F.when(x >= u, n).otherwise(0))
            ).alias("given_survived_t"),
            safe_ratio(F.sum(F.when(x >= s, n).otherwise(0)), F.sum(n)).alias("from_start"),
        )
        .withColumn("difference", F.col("given_survived_t") - F.col("from_start"))
    )
