"""Client lifetimes and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def client_lifetimes(
    shipments: DataFrame, client: str, shipped: str, data_end: str, quiet_weeks: int = 26
) -> DataFrame:
    """Whole weeks from first to last shipment and whether the client has gone quiet."""
    spans = shipments.groupBy(client).agg(
        F.min(shipped).cast("date").alias("first_date"),
        F.max(shipped).cast("date").alias("last_date"),
    )
    quiet = F.datediff(F.lit(data_end).cast("date"), F.col("last_date")) > quiet_weeks * 7
    return spans.withColumns(
        {
            "lifetime_weeks": F.floor(F.datediff("last_date", "first_date") / 7),
            "has_died": quiet,
            "churn_date": F.when(quiet, F.col("last_date")),
        }
    )


def cohort(lifetimes: DataFrame, segment: str, year: int) -> DataFrame:
    """Clients of one segment whose first shipment fell in ``year``."""
    return lifetimes.where(
        (F.col("segment") == segment) & (F.year("first_date") == year)
    ).drop("first_date", "last_date")
