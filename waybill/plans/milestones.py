"""Milestone updates: who makes them, how fast, and which are missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import safe_ratio
from waybill.operators.quality import frequencies


def milestone_updates(
    updates: DataFrame,
    legs: DataFrame,
    shipments: DataFrame,
    start: str,
    end: str,
    event_types: Sequence[str],
    half_open: bool = False,
) -> DataFrame:
    """Updates of some event types with leg and shipment attributes.

    ``created_at`` must lie in [start, end], both read as midnight, so the last
    day contributes only its first instant; ``half_open`` excludes that as well.
    """
    created = F.col("created_at")
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in (start, end))
    upper = created < hi if half_open else created <= hi
    return (
        updates.where((created >= lo) & upper & F.col("event_type").isin(*event_types))
        .join(legs, "leg_id", "left")
        .join(shipments, "shipment_id", "left")
    )


def source_share(updates: DataFrame, keep: Column, source: str) -> DataFrame:
    """Share of each source among the kept updates (rows without one are not counted)."""
    return frequencies(updates.where(keep), source)


def user_category(
    source: Column, user_type: Column, bots: Sequence[str], people: Sequence[str]
) -> Column:
    """``bot`` for automatic sources, the user's own type for manual ones, else NULL."""
    return F.when(source.isin(*bots), "bot").when(source.isin(*people), user_type)


def update_speed(
    updates: DataFrame,
    user_types: DataFrame,
    bots: Sequence[str],
    people: Sequence[str],
    low: float = -336.0,
    high: float = 0.0,
    keep: Column | None = None,
) -> DataFrame:
    """Mean lead hours by kind of user, strictly inside (low, high).

    ``keep`` chooses updates first, such as actual ones of some modes (NULL counts as no).

    Updates without source, creator or category are dropped. They are summed per
    source and creator before the lookup, so a creator with very many updates
    joins as a single row.
    """
    lead = F.col("lead_hours")
    chosen = updates if keep is None else updates.where(keep)
    summed = (
        chosen.dropna("any", subset=["source", "created_by"])
        .where((lead < high) & (lead > low))
        .groupBy("source", "created_by")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(lead).alias("_sum"))
    )
    kind = user_category(F.col("source"), F.col("user_type"), bots, people)
    return (
        summed.join(user_types, "created_by", "left")
        .withColumn("user_kind", kind)
        .where("user_kind IS NOT NULL")
        .groupBy("user_kind")
        .agg(
            F.sum("_n").alias("updates"),
            safe_ratio(F.sum("_sum"), F.sum("_n")).alias("mean_lead_hours"),
        )
    )


def missing_milestones(
    updates: DataFrame, shipments: DataFrame, expected: Sequence[str]
) -> DataFrame:
    """Shipments of each mode that lack each expected milestone.

    Missing is the number of shipments minus those with the milestone, so the
    (shipment x milestone) grid is never built.
    """
    modes = shipments.groupBy("mode").agg(F.count_distinct("shipment_id").alias("shipments"))
    names = F.array(*[F.lit(e) for e in expected])
    present = (
        updates.where(F.col("milestone").isin(*expected))
        .select("shipment_id", "milestone")
        .distinct()
        .join(shipments.select("shipment_id", "mode").distinct(), "shipment_id")
        .groupBy("mode", "milestone")
        .agg(F.count(F.lit(1)).alias("present"))
    )
    grid = modes.withColumn("milestone", F.explode(names))
    gap = F.col("shipments") - F.coalesce("present", F.lit(0))
    return grid.join(present, ["mode", "milestone"], "left").select(
        "mode",
        "milestone",
        "shipments",
        gap.alias("missing"),
        safe_ratio(gap, "shipments").alias("missing_share"),
    )


def fastest_update(updates: DataFrame) -> DataFrame:
    """Shortest delay (lead closest to 0 from below) per mode and who achieved it."""
    late = updates.where("lead_hours < 0 AND mode IS NOT NULL")
    best = F.max(F.struct("lead_hours", "update_id", "source"))
    return (
        late.groupBy("mode")
        .agg(best.alias("_b"), F.count(F.lit(1)).alias("updates"))
        .select("mode", "updates", "_b.lead_hours", "_b.update_id", "_b.source")
    )
