"""Invoice reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import boundary_diff
from waybill.operators.joins import spread_join


def _live(invoices: DataFrame) -> DataFrame:
    return (
        invoices.where("invoice_type = 'Invoice' AND invoiceable_type = 'Shipment'")
        .where("deleted_at IS NULL AND voided_at IS NULL AND issued_at IS NOT NULL")
    )


def invoice_timeliness(
    invoices: DataFrame,
    timeline: DataFrame,
    known_shipments: DataFrame,
    since: str,
    days_allowed: int = 3,
    exists_only: bool = False,
) -> DataFrame:
    """Whether each invoice was shared within ``days_allowed`` of delivery, and the gap in days.

    ``timeline`` has one row per shipment; its optional ``n_rows`` bounds the number of
    invoices of the shipment. ``known_shipments`` restricts to listed
    shipments; a shipment listed twice doubles its invoices unless ``exists_only``.
    """
    live = _live(invoices).where(F.col("issued_at") >= F.lit(since).cast("timestamp_ntz"))
    counted = ["n_rows"] if "n_rows" in timeline.columns else []
    delivered = timeline.where("delivered_at IS NOT NULL").select(
        "shipment_id", "delivered_at", *counted
    )
    how = "left_semi" if exists_only else "inner"
    delivered = delivered.join(known_shipments.select("shipment_id"), "shipment_id", how)
    if not exists_only:
        # Repeats are counted, so that the spread join sees one row per shipment.
        delivered = delivered.groupBy("shipment_id", "delivered_at", *counted).agg(
            F.count(F.lit(1)).alias("_times")
        )
    else:
        delivered = delivered.withColumn("_times", F.lit(1))
    joined = spread_join(
        live,
        delivered,
        ["shipment_id"],
        spread_by=["invoice_id", "issued_at", "revenue"],
        rows=counted[0] if counted else None,
    )
    repeated = joined.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long")))
    )
    due = F.col("delivered_at") + F.make_dt_interval(F.lit(days_allowed))
    return repeated.withColumn("share_due_at", due).select(
        "invoice_id",
        F.col("issued_at").alias("shared_at"),
        "share_due_at",
        (F.col("share_due_at") >= F.col("issued_at")).alias("on_time"),
        (boundary_diff("second", "share_due_at", "issued_at") / 86400)
        .cast("decimal(16,4)")
        .alias("days_to_share"),
    )


def invoice_details(invoices: DataFrame, start: str, end: str) -> DataFrame:
    """Live invoices issued in the half-open range [start, end)."""
    issued = F.col("issued_at")
    return (
        _live(invoices)
        .where(issued >= F.lit(start).cast("timestamp_ntz"))
        .where(issued < F.lit(end).cast("timestamp_ntz"))
        .select("invoice_id", "issuing_entity", "currency", "revenue")
    )
