"""Attach rate: how often a second service comes with the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import safe_ratio


def attach_rate(
    shipments: DataFrame, by: Sequence[str], accepted: str, attached: Column, base: Column
) -> DataFrame:
    """Monthly counts of both services per group and their ratio (NULL without a base)."""
    return (
        shipments.groupBy(*by, F.year(accepted).alias("year"), F.month(accepted).alias("month"))
        .agg(F.sum(attached).alias("n_attached"), F.sum(base).alias("n_base"))
        .withColumn("attach_rate", safe_ratio("n_attached", "n_base"))
    )
