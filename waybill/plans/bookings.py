"""Weekly bookings and shipment extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import monday_bucket
from waybill.operators.frames import dedup_first


def weekly_bookings(
    quotes: DataFrame, shipment: str, order: Sequence[str], accepted: str, level: str, levels: Sequence[str]
) -> DataFrame:
    """Shipments booked per week and service level, each shipment counted once.

    The row kept for a shipment is its first by ``order``, which must be unique.
    """
    premium = quotes.where(F.col(accepted).isNotNull() & F.col(level).isin(*levels))
    once = dedup_first(premium.select(shipment, *order, level), [shipment], order)
    return (
        once.groupBy(monday_bucket(accepted).alias("week"), F.col(level).alias("service_level"))
        .agg(F.count(F.lit(1)).alias("bookings"))
    )


def mode_tradelane(
    shipments: DataFrame, attributes: DataFrame, after: str, key: str = "shipment_id"
) -> DataFrame:
    """Live shipments accepted after a day, with mode and tradelane."""
    return (
        shipments.where("is_live")
        .where(F.col("accepted_at").cast("date") > F.lit(after).cast("date"))
        .join(attributes, key)
        .select("shipment_id", "accepted_at", "tradelane", "mode")
    )
