"""What moved a ratio or a revenue: attribution over the periods of a series.

Frames have one row per ``key`` and period, so the windows stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import safe_ratio


def cumulative_ratio(df: DataFrame, key: Sequence[str], order: str, num: str, den: str) -> DataFrame:
    """Cumulative numerator, denominator and their ratio (not the mean of ratios)."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {"cum_num": F.sum(num).over(w), "cum_den": F.sum(den).over(w)}
    ).withColumn("cum_ratio", safe_ratio("cum_num", "cum_den"))


def log_attribution(df: DataFrame, key: Sequence[str], order: str, num: str, den: str) -> DataFrame:
    """Growth of the cumulative ratio and its log parts from numerator and denominator.

    ``abs_error`` and ``rel_error`` measure how far the two parts miss the growth.
    """
    base = cumulative_ratio(df, key, order, num, den)
    w = Window.partitionBy(*key).orderBy(order)
    growth = F.try_divide(F.col("cum_ratio"), F.lag("cum_ratio").over(w)) - 1
    from_num = F.ln(safe_ratio("cum_num", F.lag("cum_num").over(w)))
    from_den = F.ln(safe_ratio(F.lag("cum_den").over(w), "cum_den"))
    return (
        base.withColumns({"growth": growth, "from_num": from_num, "from_den": from_den})
        .withColumn("abs_error", F.abs(F.col("growth") - (F.col("from_num") + F.col("from_den"))))
        .withColumn("rel_error", F.try_divide(F.col("abs_error"), F.abs("growth")))
    )


def price_volume(df: DataFrame, key: Sequence[str], order: str, revenue: str, volume: str) -> DataFrame:
    """Revenue change split into price, volume and interaction, and its log form.

    The three parts add up to the change exactly; the two log parts add up to
    the log of the revenue ratio.
    """
    w = Window.partitionBy(*key).orderBy(order)
    priced = df.withColumn("price", safe_ratio(revenue, volume))
    r, p, v = F.col(revenue), F.col("price"), F.col(volume)
    r0, p0, v0 = F.lag(revenue).over(w), F.lag("price").over(w), F.lag(volume).over(w)
    return priced.withColumns(
        {
            "revenue_change": r - r0,
            "price_effect": (p - p0) * v0,
            "volume_effect": (v - v0) * p0,
            "interaction": (p - p0) * (v - v0),
            "log_growth": F.ln(F.try_divide(r, r0)),
            "log_price": F.ln(F.try_divide(p, p0)),
            "log_volume": F.ln(safe_ratio(v, v0)),
        }
    )


def log_returns(df: DataFrame, key: Sequence[str], order: str, value: str) -> DataFrame:
    """Total log return, its mean per period, and the compounded simple return."""
    w = Window.partitionBy(*key).orderBy(order)
    before = F.lag(value).over(w)
    steps = df.withColumns(
        {
            "_log": F.ln(F.try_divide(F.col(value), before)),
            "_simple": F.try_divide(F.col(value), before) - 1,
        }
    )
    return steps.groupBy(*key).agg(
        F.count("_log").alias("periods"),
        F.sum("_log").alias("total_log_return"),
        F.avg("_log").alias("mean_log_return"),
        (F.exp(F.sum(F.ln(1 + F.col("_simple")))) - 1).alias("compounded_return"),
    )
