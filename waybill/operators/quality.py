"""Profiles of a fresh extract: nulls, grain, frequencies, spread, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import safe_ratio
from waybill.operators.ordered import quantiles, running_totals
from waybill.operators.staging import one_row, staged


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, null fraction and any-null flag of every column, in one pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    tall = wide.unpivot(["_rows"], list(df.columns), "column_name", "filled")
    return tall.select(
        "column_name",
        F.col("_rows").alias("n_rows"),
        safe_ratio(F.col("_rows") - F.col("filled"), "_rows").alias("null_fraction"),
        (F.col("filled") < F.col("_rows")).alias("has_nulls"),
    )


def distinct_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values of each column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "n_distinct")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max of each column, NULLs ignored."""
    tall = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    tall = tall.where("value IS NOT NULL")
    basic = tall.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    middle = quantiles(tall, ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return basic.join(middle, "column_name").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Multiplicity of each key, highest first; a clean key has only 1s."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), *[F.asc_nulls_first(k) for k in keys])
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each non-null value."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("value", "n", safe_ratio("n", total).alias("share"))


def category_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of every value of several columns, from one pass; NULL is a value of its own."""
    tall = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    counts = tall.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n")).scalar() / len(columns)
    return counts.select("column_name", "value", "n", safe_ratio("n", rows).alias("share"))


def repeated_share(df: DataFrame, key: str, more_than: int = 1) -> DataFrame:
    """Share of keys that occur more than ``more_than`` times."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.avg((F.col("n") > more_than).cast("double")).alias("share_repeated"),
    )


def group_quantiles(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return quantiles(df, by, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})


def rate(df: DataFrame, by: Sequence[str], flag: Column, name: str = "rate") -> DataFrame:
    """Mean of a boolean per group, with the number of rows behind it."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(flag.cast("double")).alias(name)
    )


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width histogram with counts, density and cumulative share per bin.

    Bins are closed on the left and open on the right except the last, which is
    closed; without ``bounds`` they span the data (half a unit each way for a
    constant column). Empty bins are kept, values outside ``bounds`` are not counted.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    if bounds is None:
        span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where("lo IS NOT NULL")
        span = span.select(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
        placed = values.withColumn("_span", one_row(span))
        lo, hi = F.col("_span.lo"), F.col("_span.hi")
    else:
        placed = values
        lo, hi = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("int")
    # The bins are kept together with their bounds: two passes over the facts in all.
    counts = staged(
        placed.where((F.col("x") >= lo) & (F.col("x") <= hi))
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.first(lo).alias("lo"), F.first(hi).alias("hi"))
    )
    known = one_row(
        counts.agg(F.sum("n").alias("total"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    )
    grid = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), known.alias("_known")
    )
    if bounds is None:
        lo, hi = F.col("_known.lo"), F.col("_known.hi")
        width = (hi - lo) / bins
    total = F.col("_total")
    full = grid.where("_known.total IS NOT NULL").join(counts.select("bin", "n"), "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("left_edge"),
        (lo + (F.col("bin") + 1) * width).alias("right_edge"),
        (lo + (F.col("bin") + 0.5) * width).alias("midpoint"),
        F.coalesce("n", F.lit(0)).alias("n"),
        width.alias("_width"),
        F.col("_known.total").alias("_total"),
    )
    summed = running_totals(full, [], ["bin"], {"_cum": F.col("n")})
    return summed.select(
        "bin",
        "left_edge",
        "right_edge",
        "midpoint",
        "n",
        safe_ratio("n", total * F.col("_width")).alias("density"),
        safe_ratio("_cum", total).alias("cumulative"),
    )
