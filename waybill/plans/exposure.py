"""Capital at risk per calendar day.

Summing over (days x facts) with an "is open that day" test needs every pair.
Instead each fact adds its value on its first day and takes it back after its
last; the daily figure is the running sum of those changes. Facts are reduced to
one change per day before anything is ordered, so only the calendar is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators.frames import impute_group_median

MONEY = "decimal(28,4)"

# The milestones at which goods start and end their transit, by freight type, and the
# milestones that stand in for an end that is not known, in this order.
TRANSIT = {
    "Door to Door": ("actual_origin_departed_at", "actual_in_full_delivered_at"),
    "Door to Port": ("actual_origin_departed_at", "actual_arrival_port_arrived_at"),
    "Port to Door": ("actual_departure_port_departed_at", "actual_in_full_delivered_at"),
    "Port to Port": ("actual_departure_port_departed_at", "actual_arrival_port_arrived_at"),
}
TRANSIT_END_FALLBACKS = ("actual_first_delivered_at", "actual_arrival_port_arrived_at")


def sweep_sum(
    facts: DataFrame, first_day: Column, last_day: Column, value: Column, start: str, end: str
) -> DataFrame:
    """Change of the open value per day, clipped to [start, end].

    Intervals include both days. Reversed, unbounded-NULL and outside intervals
    add nothing.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    open_facts = (
        facts.select(first_day.alias("_from"), last_day.alias("_to"), value.cast(MONEY).alias("_v"))
        .where("_from <= _to AND _v IS NOT NULL")
        .where((F.col("_to") >= lo) & (F.col("_from") <= hi))
    )
    changes = open_facts.select(
        F.inline(
            F.array(
                F.struct(F.greatest("_from", lo).alias("day"), F.col("_v").alias("change")),
                F.struct(F.date_add("_to", 1).alias("day"), (-F.col("_v")).alias("change")),
            )
        )
    )
    return changes.where(F.col("day") <= hi).groupBy("day").agg(F.sum("change").alias("change"))


def open_by_day(changes: DataFrame, days: DataFrame, name: str) -> DataFrame:
    """Running sum of the changes on every calendar day; 0 on days with nothing open."""
    w = Window.orderBy("date_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = days.join(changes.withColumnRenamed("day", "date_day"), "date_day", "left")
    return joined.select(
        "date_day",
        F.sum(F.coalesce("change", F.lit(0).cast(MONEY))).over(w).alias(name),
    )


def imputed_values(
    shipments: DataFrame, values: DataFrame, reference: tuple[str, str]
) -> DataFrame:
    """Shipment values, missing ones replaced by the client's median of a reference period.

    ``values`` has ``client_id, value, keyed_at``; only rows keyed between the two
    reference dates form the medians.
    """
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in reference)
    known = values.where((F.col("keyed_at") >= lo) & (F.col("keyed_at") <= hi))
    return impute_group_median(
        shipments, "client_id", "value", "imputed_value", spread_by=["shipment_id"], reference=known
    )


def transit_interval(
    shipments: DataFrame,
    rules: Mapping[str, tuple[str, str]] = TRANSIT,
    fallbacks: Sequence[str] = TRANSIT_END_FALLBACKS,
    freight_type: str = "freight_type",
) -> DataFrame:
    """Add ``start_at`` and ``end_at`` of the transit: the milestones that the freight type names.

    An end that is NULL is the first of ``fallbacks`` that is known; a start has no stand-in. A freight
    type without a rule has no start, and its end comes from the fallbacks alone.
    """
    kind = F.col(freight_type)
    ends = []
    for side in (0, 1):
        chosen = F.lit(None).cast("timestamp_ntz")
        for name, milestones in rules.items():
            chosen = F.when(kind == name, F.col(milestones[side])).otherwise(chosen)
        ends.append(chosen)
    return shipments.withColumns(
        {"start_at": ends[0], "end_at": F.coalesce(ends[1], *[F.col(c) for c in fallbacks])}
    )


def financed(invoices: DataFrame) -> DataFrame:
    """Shipments with a live invoice that has a financed amount, each once."""
    live = invoices.where("invoice_type = 'Invoice' AND invoiceable_type = 'Shipment'")
    live = live.where("deleted_at IS NULL AND voided_at IS NULL AND capital_amount > 0")
    return live.select("shipment_id").distinct()


def transit_collateral(
    shipments: DataFrame,
    invoices: DataFrame,
    values: DataFrame,
    days: DataFrame,
    start: str,
    end: str,
    reference: tuple[str, str],
) -> DataFrame:
    """Value in transit per day of live, financed shipments.

    Transit follows from the freight type, a missing value is the client's median of the
    ``reference`` period. ``shipments`` has ``is_live``, ``client_id``, ``value`` and the milestones.
    """
    live = shipments.where("is_live").join(financed(invoices), "shipment_id", "left_semi")
    moved = transit_interval(live).where("start_at <= end_at")
    return daily_collateral(imputed_values(moved, values, reference), days, start, end)


def daily_collateral(shipments: DataFrame, days: DataFrame, start: str, end: str) -> DataFrame:
    """Value in transit per day of shipments with ``start_at``, ``end_at``, ``imputed_value``.

    A day counts if its midnight lies in [start_at, end_at].
    """
    begins = F.col("start_at").cast("date")
    first = F.when(
        begins.cast("timestamp_ntz") == F.col("start_at"), begins
    ).otherwise(F.date_add(begins, 1))
    changes = sweep_sum(
        shipments, first, F.col("end_at").cast("date"), F.col("imputed_value"), start, end
    )
    out = open_by_day(changes, days, "in_transit_value")
    return out.withColumn("in_transit_value", F.round("in_transit_value", 2))


def daily_outstanding(
    repayments: DataFrame, originations: DataFrame, days: DataFrame, start: str, end: str
) -> DataFrame:
    """Principal outstanding per day.

    A repayment is open from its outlay until the day before it is collected or
    charged off (the later, if both apply), without end if neither happened.
    """
    live = originations.where("is_live_origination").select("origination_id")
    kept = repayments.where("NOT is_deleted").join(live, "origination_id")
    collected, charged = F.col("is_collected"), F.col("is_charged_off")
    until = F.when(
        ~collected & ~charged, F.date_add(F.lit(end).cast("date"), 1)
    ).otherwise(
        F.greatest(F.when(collected, F.col("repaid_on")), F.when(charged, F.col("charged_off_on")))
    )
    changes = sweep_sum(
        kept, F.col("outlaid_on"), F.date_add(until, -1), F.col("principal"), start, end
    )
    return open_by_day(changes, days, "outstanding_principal")


def exposure_report(days: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Daily figures side by side on the calendar."""
    out = days
    for part in parts:
        out = out.join(part, "date_day", "left")
    return out
