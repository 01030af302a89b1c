"""Calendar tables. Their size is the number of periods, not the number of facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(
    spark: SparkSession, start: str, end: str, step: str = "1 day", name: str = "date_day"
) -> DataFrame:
    """One row per ``step`` from ``start`` to ``end``, both included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {step}")
            )
        ).alias(name)
    )


def quarters(spark: SparkSession, start: str, end: str, name: str = "quarter") -> DataFrame:
    return calendar(spark, start, end, "3 months", name)


def calendar_spanning(
    df: DataFrame, column: str, step: str = "1 day", name: str = "date_day"
) -> DataFrame:
    """Calendar from the smallest to the largest value of a date or timestamp column."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return bounds.where("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi", F.expr(f"interval {step}"))).alias(name)
    )
