"""CSV readers. A schema is always required: inference would scan the data twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV with NaN and empty fields read as NULL."""
    raw = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return raw.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in raw.dtypes
        ]
    )


def read_series_csv(
    spark: SparkSession, path: str, schema: str, date: str, value: str, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """One series of a wide CSV as ``(ts, value)``; names are matched in lower case."""
    raw = read_csv(spark, path, schema)
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    return raw.select(
        F.to_date(F.col(date.lower()), date_format).alias("ts"),
        F.col(value.lower()).cast("double").alias("value"),
    )
