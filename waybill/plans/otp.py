"""On-time performance of shipments from milestone columns.

One shipment row carries ``actual_*`` and ``scheduled_*`` milestone timestamps
(plain and ``_local``), the volume kind, freight types and quoted transit days.
Which milestone starts and ends the responsible part of the trip depends on kind
and freight type; that is written down once as a rule table, joined to the
shipments, and read by one short ``CASE`` per derived column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import boundary_diff, quarter_start, same_text, truthy
from waybill.operators.frames import group_totals
from waybill.operators.joins import spread_join

PORT_DOOR, PORT_PORT = "Port to Door", "Port to Port"
DOOR_PORT, DOOR_DOOR = "Door to Port", "Door to Door"
ON_TIME, LATE, NOT_ELIGIBLE = "True", "False", "Not Eligible"

FCL, LCL, AIR = "fcl", "lcl", "air"

_DELIVERED = ("actual_in_full_delivered_at", "scheduled_in_full_delivered_at")
_AIR_END = (
    "actual_deconsolidation_ready_for_pickup_at",
    "actual_deconsolidation_departed_at",
    "actual_arrival_port_departed_at",
)
_AIR_SCHEDULED = ("scheduled_deconsolidation_departed_at", "scheduled_arrival_port_departed_at")
_READY = ("actual_cargo_ready_date_local",)
_PORT = ("actual_departure_port_arrived_at",)
_CONSOLIDATION = ("actual_consolidation_arrived_at",)


@dataclass(frozen=True)
class TripRule:
    """Columns of one (kind, freight type); each tuple is coalesced left to right."""

    kind: str
    freight_type: str
    start: tuple[str, ...]
    completion: tuple[str, ...]
    local_completion: tuple[str, ...]
    end: tuple[str, ...]


def _rule(kind, freight, start, completion, end, local=None) -> TripRule:
    return TripRule(
        kind, freight, start, completion, local or tuple(f"{c}_local" for c in end), end
    )


# The business rules, in the order in which they are tried. Door
# trips deliberately start at a local column and end at a plain one.
TRIP_RULES = (
    _rule(FCL, PORT_DOOR, _PORT, _DELIVERED, _DELIVERED[:1]),
    _rule(
        FCL,
        PORT_PORT,
        _PORT,
        ("actual_final_port_departed_at", "scheduled_final_port_departed_at"),
        ("actual_final_port_departed_at",),
    ),
    _rule(
        FCL,
        DOOR_PORT,
        _READY,
        ("actual_final_port_departed_at", "scheduled_final_port_departed_at"),
        ("actual_final_port_departed_at",),
    ),
    _rule(LCL, PORT_DOOR, _CONSOLIDATION, _DELIVERED, _DELIVERED[:1]),
    _rule(
        LCL,
        PORT_PORT,
        _CONSOLIDATION,
        ("actual_deconsolidation_departed_at", "scheduled_deconsolidation_departed_at"),
        ("actual_deconsolidation_departed_at",),
    ),
    # This rule completes on the scheduled column, for the local test as well.
    _rule(
        LCL,
        DOOR_PORT,
        _READY,
        ("scheduled_deconsolidation_departed_at",),
        ("actual_deconsolidation_departed_at",),
        ("scheduled_deconsolidation_departed_at_local",),
    ),
    _rule(FCL, DOOR_DOOR, _READY, _DELIVERED, _DELIVERED[:1]),
    _rule(LCL, DOOR_DOOR, _READY, _DELIVERED, _DELIVERED[:1]),
    _rule(AIR, PORT_DOOR, _CONSOLIDATION + _PORT, _DELIVERED, _DELIVERED[:1]),
    _rule(AIR, PORT_PORT, _CONSOLIDATION + _PORT, _AIR_END + _AIR_SCHEDULED, _AIR_END),
    _rule(AIR, DOOR_PORT, _READY, _AIR_END + _AIR_SCHEDULED, _AIR_END),
    _rule(AIR, DOOR_DOOR, _READY, _DELIVERED, _DELIVERED[:1]),
)

_PORTS = (
    "first_port_arrived",
    "first_port_departed",
    "final_port_arrived",
    "final_port_departed",
)
_ORIGIN = ("cargo_ready_date", "origin_departed")
_CONSOL = (
    "consolidation_arrived",
    "consolidation_departed",
    "deconsolidation_arrived",
    "deconsolidation_departed",
)
_FULL, _ANY = ("in_full_delivered",), ("in_full_delivered|first_delivered",)

# Groups of milestones every shipment of a kind and freight type
# must have. "a|b" is satisfied by either.
REQUIRED_MILESTONES = {
    (FCL, PORT_DOOR): (_ORIGIN, _PORTS, _FULL),
    (FCL, PORT_PORT): (_PORTS,),
    (FCL, DOOR_DOOR): (_ORIGIN, _PORTS, _FULL),
    (FCL, DOOR_PORT): (_ORIGIN, _PORTS),
    (LCL, PORT_DOOR): (_CONSOL, _PORTS, _ANY),
    (LCL, PORT_PORT): (_CONSOL, _PORTS),
    (LCL, DOOR_DOOR): (_ORIGIN, _CONSOL, _PORTS, _ANY),
    (LCL, DOOR_PORT): (_ORIGIN, _CONSOL, _PORTS),
    (AIR, PORT_DOOR): (_CONSOL, _PORTS, _ANY),
    (AIR, PORT_PORT): (_CONSOL, _PORTS),
    (AIR, DOOR_DOOR): (_ORIGIN, _CONSOL, _PORTS, _ANY),
    (AIR, DOOR_PORT): (_ORIGIN, _CONSOL, _PORTS),
}


_GROUPS = {"origin": _ORIGIN, "ports": _PORTS, "consol": _CONSOL, "full": _FULL, "any": _ANY}


@dataclass(frozen=True)
class Kinds:
    """How the volume kinds are spelled in the data."""

    fcl: Sequence[str] = ("fcl",)
    lcl: Sequence[str] = ("lcl",)
    volume_column: str = "volume_kind"
    ocean_freight_column: str = "ocean_freight_type"
    air_freight_column: str = "air_freight_type"
    air_flag_column: str = "is_air"

    def ocean_kind(self) -> Column:
        volume = F.col(self.volume_column)
        return F.when(volume.isin(*self.fcl), FCL).when(volume.isin(*self.lcl), LCL)

    def air_kind(self) -> Column:
        return F.when(F.col(self.air_flag_column), AIR)


def rule_table(spark: SparkSession, prefix: str) -> DataFrame:
    """The rules as rows: kind, freight type, rule number, groups of milestones needed."""
    rows = []
    for i, rule in enumerate(TRIP_RULES):
        needed = REQUIRED_MILESTONES[rule.kind, rule.freight_type]
        flags = [str(group in needed) for group in _GROUPS.values()]
        rows.append(f"('{rule.kind}', '{rule.freight_type}', {i}, {', '.join(flags)})")
    names = ["kind", "freight", "rule", *[f"needs_{name}" for name in _GROUPS]]
    columns = ", ".join(f"{prefix}{name}" for name in names)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS rules({columns})")


def with_rules(shipments: DataFrame, kinds: Kinds) -> DataFrame:
    """Attach the rule of each shipment: the ocean rule if one matches, else the air rule.

    The rule table has twelve rows, so both joins are broadcasts.
    """
    spark = shipments.sparkSession
    keyed = shipments.withColumns({"_ocean": kinds.ocean_kind(), "_air": kinds.air_kind()})
    ocean, air = rule_table(spark, "_o_"), rule_table(spark, "_a_")
    joined = keyed.join(
        F.broadcast(ocean),
        (F.col("_ocean") == F.col("_o_kind"))
        & (F.col(kinds.ocean_freight_column) == F.col("_o_freight")),
        "left",
    ).join(
        F.broadcast(air),
        (F.col("_air") == F.col("_a_kind"))
        & (F.col(kinds.air_freight_column) == F.col("_a_freight")),
        "left",
    )
    # A shipment of an ocean kind is never judged complete by the air list.
    needs = [
        f"CASE WHEN _ocean IS NOT NULL THEN _o_needs_{name} ELSE _a_needs_{name} END AS _needs_{name}"
        for name in _GROUPS
    ]
    return joined.selectExpr(
        *shipments.columns, "_ocean", "_air", "coalesce(_o_rule, _a_rule) AS _rule", *needs
    )


_HELPERS = ["_ocean", "_air", "_rule", *[f"_needs_{name}" for name in _GROUPS]]


def _choose(part: str) -> Column:
    """Coalesced columns of ``part`` under the attached rule; NULL without one.

    Rules that read the same columns share a branch.
    """
    sharing: dict[tuple[str, ...], list[str]] = {}
    for i, rule in enumerate(TRIP_RULES):
        sharing.setdefault(tuple(getattr(rule, part)), []).append(str(i))
    branches = [
        f"WHEN _rule IN ({', '.join(numbers)}) THEN coalesce({', '.join(names)})"
        for names, numbers in sharing.items()
    ]
    return F.expr(f"CASE {' '.join(branches)} END")


def _trip(ruled: DataFrame) -> DataFrame:
    return (
        ruled.withColumns(
            {
                "start_at": _choose("start"),
                "_end_at": _choose("end"),
                "completion_date": _choose("completion").cast("date"),
                "local_completion_date": _choose("local_completion").cast("date"),
            }
        )
        .withColumn("transit_days", boundary_diff("hour", "start_at", "_end_at") / 24)
        .drop("_end_at")
    )


def _complete() -> Column:
    """Whether every group of milestones the rule needs is present."""
    parts = ["_needs_ports IS NOT NULL"]  # there is a rule at all
    for name, group in _GROUPS.items():
        present = [
            f"coalesce({', '.join(f'actual_{p}_local' for p in _parts(m))}) IS NOT NULL" for m in group
        ]
        parts.append(f"(NOT _needs_{name} OR ({' AND '.join(present)}))")
    return F.expr(f"coalesce({' AND '.join(parts)}, false)")


def _parts(name: str) -> list[str]:
    # The cargo-ready milestone is itself a date; the others carry "_at".
    return [p if p == "cargo_ready_date" else f"{p}_at" for p in name.split("|")]


def responsible_trip(shipments: DataFrame, kinds: Kinds = Kinds()) -> DataFrame:
    """Add start, completion date, local completion date and transit days."""
    return _trip(with_rules(shipments, kinds)).drop(*_HELPERS)


def otp_status(shipments: DataFrame, as_of: str, kinds: Kinds = Kinds()) -> DataFrame:
    """Add ``transit_on_time`` (True / False / Not Eligible) and ``milestones_complete``.

    On time means completed inside [start + quoted min, start + quoted max].
    A quoted ocean shipment whose window has not opened by ``as_of`` is not
    eligible; everything else, including unknown, is False.
    """
    start = F.col("start_at").cast("date")

    def deadline(which: str) -> Column:
        days = F.when(F.col("_ocean").isNotNull(), F.col(f"ocean_transit_{which}")).when(
            F.col("_air").isNotNull(), F.col(f"air_transit_{which}")
        )
        return F.date_add(start, days)

    trip = _trip(with_rules(shipments, kinds)).withColumns(
        {"_opens": deadline("min"), "_closes": deadline("max")}
    )
    air = F.col("_air").isNotNull()
    inside = F.col("local_completion_date").between(F.col("_opens"), F.col("_closes"))
    finished = F.col("transit_days").isNotNull()
    ocean_quoted = F.col("ocean_transit_min").isNotNull() & F.col("ocean_transit_max").isNotNull()
    air_quoted = F.col("air_transit_min").isNotNull() & F.col("air_transit_max").isNotNull()
    not_due = F.lit(as_of).cast("date") < F.col("_opens")
    status = (
        F.when(finished & inside & (ocean_quoted | (air & air_quoted)), ON_TIME)
        # Whether the trip has finished makes no difference to this branch.
        .when(ocean_quoted & not_due, NOT_ELIGIBLE)
        .otherwise(LATE)
    )
    return trip.withColumns(
        {
            "transit_on_time": status,
            "milestones_complete": F.when(_complete(), "Yes").otherwise("No"),
        }
    ).drop("_opens", "_closes", *_HELPERS)


def otp_report(
    status: DataFrame,
    as_of: str,
    region: str,
    final_status: str,
    columns: Sequence[str],
) -> DataFrame:
    """Distinct report rows of finished trips to a region in a two-quarter window.

    The window is the quarter before that of ``as_of`` and that of ``as_of``.
    """
    first = F.add_months(quarter_start(F.lit(as_of)), -3)
    done = F.col("completion_date")
    return (
        status.where(F.col("freight_type").isNotNull())
        .where(same_text("transportation_status", F.lit(final_status)))
        .where("wants_freight")
        .where(same_text("destination_region", F.lit(region)))
        .where((done >= first) & (done < F.add_months(first, 6)))
        .select(*columns)
        .distinct()
    )


def otp_rate(report: DataFrame, mode: str, date: str, on_time: Column) -> DataFrame:
    """On-time share by mode, year and month of a date column."""
    return report.groupBy(
        F.col(mode).alias("mode"), F.year(date).alias("year"), F.month(date).alias("month")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg(on_time.cast("double")).alias("otp_rate"))


def otp_rate_from_status(report: DataFrame, mode: str, date: str) -> DataFrame:
    """As ``otp_rate`` on shipments with complete milestones and a text status."""
    complete = report.where(truthy("milestones_complete"))
    return otp_rate(complete, mode, date, F.coalesce(truthy("transit_on_time"), F.lit(False)))


_LEGS = ("origin", "origin_dwell", "port_to_port", "destination_dwell", "destination")


def quoted_transit_total(
    times: DataFrame, quotes: DataFrame, predicted: DataFrame, sources: DataFrame
) -> DataFrame:
    """Quoted and predicted total transit days, missing legs counting as 0.

    ``times`` and ``predicted`` have ``quote_id`` and ``<leg>_days``; ``quotes``
    restricts to accepted, not voided ones; ``sources`` names the data source.
    """

    def total(prefix: str) -> Column:
        return sum(
            (F.coalesce(F.col(f"{prefix}{leg}_days"), F.lit(0)) for leg in _LEGS), F.lit(0)
        )

    live = quotes.where(F.col("accepted_at").isNotNull() & F.col("voided_at").isNull())
    guess = predicted.select(
        "quote_id", *[F.col(f"{leg}_days").alias(f"predicted_{leg}_days") for leg in _LEGS]
    )
    return (
        times.join(live.drop("accepted_at", "voided_at"), "quote_id", "left")
        .where("shipment_id IS NOT NULL")
        .join(sources, "data_source", "left")
        .join(guess, "quote_id", "left")
        .withColumns(
            {
                "total_transit_days": total(""),
                "predicted_total_transit_days": total("predicted_"),
            }
        )
    )


def quote_enrichment(
    quotes: DataFrame, items: DataFrame, times: DataFrame, autobooked: DataFrame, labels: Sequence[str]
) -> DataFrame:
    """Quote rows with the figures of their shipment and client.

    Adds won and lost cost, the acceptor category (``labels``: autobooked,
    impersonated, client), the blended mode, the air flag of the quote, and
    maxima / minima over the shipment or client. Whole-group values are aggregated
    and brought together per pair of shipment and client, so that the quotes are
    joined to all of them at once; a hot shipment, client or pair is spread over tasks.
    ``quotes`` and ``times`` are read several times and should be stored tables.
    """
    accepted = F.col("quote_accepted_date")
    cost = F.col("cost")
    pair = ["shipment_id", "client_id"]
    days = ["origin_days", "destination_days", "port_to_port_days"]
    air = items.groupBy("quote_id").agg((F.min("template_id") == 1).alias("is_air_quote"))
    legs = times.select("quote_id", *days)
    # Maxima and minima need no joined rows; the days of legs are joined for theirs alone.
    by_shipment = group_totals(
        quotes,
        ["shipment_id"],
        {
            "won_cost": F.max(F.when(accepted.isNotNull(), cost)),
            "lost_cost": F.min(F.when(~F.col("is_live"), cost)),
            "quoted_chargeable_weight": F.max("chargeable_weight"),
            "quoted_teu": F.max("teu"),
            "quoted_volume": F.max("volume"),
            "quoted_transit_max": F.max("transit_time_max"),
            "quoted_transit_min": F.min("transit_time_min"),
            "hours_to_share": F.min(boundary_diff("hour", "requested_at", "submitted_at")),
        },
    )
    longest = (
        quotes.select("quote_id", "shipment_id")
        .join(legs, "quote_id")
        .groupBy("shipment_id")
        .agg(*[F.max(d).alias(f"quoted_{d}") for d in days])
    )
    by_client = group_totals(
        quotes,
        ["client_id"],
        {
            "first_air_acceptance": F.min(F.when(F.col("mode") == "Air", accepted)),
            "last_acceptance": F.max(accepted),
        },
    )
    by_pair = quotes.groupBy(*pair).agg(F.count(F.lit(1)).alias("_rows"))
    booked = autobooked.select(*pair).distinct().withColumn("_autobooked", F.lit(True))
    figures = by_pair.drop("_rows").join(booked, pair, "left")
    # Each table knows how many rows its keys have at most, so nothing else is read to find hot keys.
    figures = spread_join(figures, by_client, ["client_id"], ["shipment_id"], "left", rows="_rows")
    shipments = by_shipment.join(longest, "shipment_id", "left")
    figures = spread_join(
        figures, shipments.drop("_rows"), ["shipment_id"], ["client_id"], "left", counts=by_shipment.select("shipment_id", "_rows")
    )

    def keyed(df: DataFrame) -> DataFrame:
        """The pair as one column, in which a missing shipment or client equals another."""
        return df.withColumn("_pair", F.struct(*pair)).drop(*pair)

    # Days of legs were joined by times; those of one quote may have several rows.
    base = quotes.join(legs, "quote_id", "left").join(air, "quote_id", "left")
    flagged = spread_join(
        keyed(base), keyed(figures), ["_pair"], spread_by=["quote_id"], how="left", counts=keyed(by_pair)
    ).select(*[c for c in base.columns if c not in pair], *[F.col(f"_pair.{c}").alias(c) for c in pair], *[c for c in figures.columns if c not in pair])
    autobook, impersonated, client = labels
    return flagged.withColumns(
        {
            "acceptor": F.when(F.col("_autobooked").isNotNull(), autobook)
            .when(F.col("acceptor_is_staff"), impersonated)
            .otherwise(client),
            "mode_blended": F.when(
                (F.col("mode") == "Ocean") & (F.col("lcl") == "LCL"), "Ocean LCL"
            )
            .when((F.col("mode") == "Ocean") & (F.col("lcl") == "Not LCL"), "Ocean FCL")
            .otherwise(F.col("mode")),
            "total_cost": F.coalesce("won_cost", F.lit(0)) + F.coalesce("lost_cost", F.lit(0)),
        }
    ).drop("_autobooked")
