"""Change trails from an audit log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import change_value, lenient_date, strip_quotes
from waybill.operators.joins import spread_join
from waybill.operators.ordered import quantiles, with_history


def change_extract(
    audits: DataFrame,
    legs: DataFrame,
    quotes: DataFrame,
    field: str,
    start: str,
    end: str,
    audited_types: Sequence[str],
) -> DataFrame:
    """Audit rows that changed ``field`` of an origin leg with an accepted quote.

    ``legs`` carries the boolean ``from_origin``, ``audits`` the type of what was
    audited and the JSON ``changes``; ``quotes`` has when each was submitted and accepted. A shipment with
    several accepted quotes repeats its changes, once for each.
    """
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in (start, end))
    recent = audits.where((F.col("changed_at") >= lo) & (F.col("changed_at") <= hi)).where(
        F.col("audited_type").isin(*audited_types)
    )
    rows = (
        recent.withColumn("new_value", change_value("changes", field))
        .where("new_value IS NOT NULL")
        .select("audit_id", "leg_id", "action", "changed_at", "new_value")
    )
    # Legs meet their quotes first, so that the log is joined once; a leg with very
    # many changes is spread over tasks. Counting them needs no document to be parsed.
    per_leg = recent.groupBy("leg_id").agg(F.count(F.lit(1)).alias("_rows"))
    accepted = quotes.where("quote_accepted_at IS NOT NULL").select(
        "shipment_id", "quote_submitted_at", "quote_accepted_at"
    )
    eligible = legs.where("from_origin").select("leg_id", "shipment_id").join(accepted, "shipment_id")
    return spread_join(rows, eligible, ["leg_id"], spread_by=["audit_id"], counts=per_leg).select(
        "audit_id",
        "leg_id",
        "action",
        "shipment_id",
        "changed_at",
        "new_value",
        "quote_submitted_at",
        "quote_accepted_at",
    )


def changes_per_key(changes: DataFrame, key: str = "leg_id", top: int | None = None) -> DataFrame:
    """How many keys changed how often, their share of all keys, the commonest number of changes first.

    ``top`` keeps the commonest ones. Rows without a key are left out. The result has a row per number of
    changes, however many keys there are.
    """
    per_key = changes.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_changes"))
    counted = per_key.groupBy("n_changes").agg(F.count(F.lit(1)).alias("keys"))
    all_keys = counted.agg(F.sum("keys")).scalar()
    shares = counted.withColumn("share", F.col("keys") / all_keys).orderBy(F.desc("keys"), "n_changes")
    return shares.limit(top) if top is not None else shares


def change_trail(
    changes: DataFrame,
    key: str = "leg_id",
    changed_at: str = "changed_at",
    tie_break: str = "audit_id",
    value: str = "new_value",
) -> DataFrame:
    """Each change with its order, previous and first date and the days moved.

    Text that is no date becomes NULL. The first record of a key has no distance
    to the first. A key of any size is split along its order.
    """
    dated = changes.withColumn("change_date", lenient_date(strip_quotes(value)))
    trail = with_history(
        dated,
        [key],
        [changed_at, tie_break],
        ["change_date"],
        position="change_order",
    )
    from_first = F.datediff("change_date", "change_date_first")
    return trail.withColumns(
        {
            "days_from_prev": F.datediff("change_date", "change_date_prev"),
            "days_from_first": F.when(F.col("change_order") != 1, from_first),
        }
    )


def change_by_order(trail: DataFrame) -> DataFrame:
    """Changes and mean distance to the first by order number."""
    return trail.groupBy("change_order").agg(
        F.count(F.lit(1)).alias("changes"),
        F.avg("days_from_first").alias("mean_days_from_first"),
    )


def change_quantiles(trail: DataFrame) -> DataFrame:
    """Quartiles of the distance to the first by order number."""
    return quantiles(
        trail.select("change_order", "days_from_first"),
        ["change_order"],
        "days_from_first",
        {"q25": 0.25, "q50": 0.5, "q75": 0.75},
    )
