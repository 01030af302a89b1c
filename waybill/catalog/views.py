"""The library's input frames, expressed over the star-schema tables.

Where the schema lacks a column (milestones, freight types, quotes) it is derived
from keys and dates by modular arithmetic, so every frame grows with its tables.
``*_SQL`` texts are the same definitions for the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.sources import Tables

FREIGHT_TYPES = ("Port to Door", "Port to Port", "Door to Port", "Door to Door")

# Milestone column: (first day, spread in days, spread in hours, one in how many missing).
MILESTONES = {
    "actual_cargo_ready_date_local": (0, 3, 17, 23),
    "actual_origin_departed_at_local": (1, 3, 19, 29),
    "actual_departure_port_arrived_at": (1, 4, 22, 31),
    "actual_consolidation_arrived_at": (1, 5, 13, 19),
    "actual_consolidation_arrived_at_local": (1, 5, 11, 19),
    "actual_consolidation_departed_at_local": (2, 5, 11, 41),
    "actual_first_port_arrived_at_local": (3, 3, 7, 43),
    "actual_first_port_departed_at_local": (4, 3, 7, 47),
    "actual_final_port_arrived_at_local": (8, 9, 5, 37),
    "actual_final_port_departed_at": (9, 12, 23, 11),
    "actual_final_port_departed_at_local": (9, 12, 21, 11),
    "actual_arrival_port_departed_at": (9, 8, 23, 4),
    "actual_arrival_port_departed_at_local": (9, 8, 21, 4),
    "actual_deconsolidation_arrived_at_local": (9, 9, 9, 53),
    "actual_deconsolidation_departed_at": (10, 14, 20, 7),
    "actual_deconsolidation_departed_at_local": (10, 14, 18, 7),
    "actual_deconsolidation_ready_for_pickup_at": (10, 6, 14, 3),
    "actual_deconsolidation_ready_for_pickup_at_local": (10, 6, 12, 3),
    "actual_first_delivered_at_local": (11, 13, 16, 17),
    "actual_in_full_delivered_at": (12, 18, 24, 5),
    "actual_in_full_delivered_at_local": (12, 18, 22, 5),
    "scheduled_final_port_departed_at": (9, 10, 6, 61),
    "scheduled_arrival_port_departed_at": (9, 7, 6, 59),
    "scheduled_deconsolidation_departed_at": (10, 12, 6, 13),
    "scheduled_deconsolidation_departed_at_local": (10, 12, 4, 13),
    "scheduled_in_full_delivered_at": (12, 15, 6, 67),
}


def timeline(t: Tables) -> DataFrame:
    """One row per order: first and last ship date and number of lines."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("shipment_id")).agg(
        F.min("l_shipdate").alias("departed_at"),
        F.max("l_shipdate").alias("delivered_at"),
        F.count(F.lit(1)).alias("n_lines"),
    )


TIMELINE_SQL = """timeline AS (
  SELECT l_orderkey AS shipment_id, min(l_shipdate) AS departed_at,
         max(l_shipdate) AS delivered_at, count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey)"""


def client_regions(t: Tables) -> DataFrame:
    """Customer with nation and region names (the two small tables are joined first)."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name"
    )


REGIONS_SQL = """client_regions AS (
  SELECT c_custkey, c_mktsegment, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def otp_shipments(t: Tables) -> DataFrame:
    """One row per order with every milestone, quote window and filter column."""
    base = (
        t.orders.join(timeline(t), F.col("o_orderkey") == F.col("shipment_id"))
        .join(client_regions(t), F.col("o_custkey") == F.col("c_custkey"))
    )
    labels = ", ".join(f"'{name}'" for name in FREIGHT_TYPES)
    return base.selectExpr(
        "*", f"element_at(array({labels}), int(o_orderkey div 3 % 4) + 1) AS freight", "o_orderkey AS k"
    ).selectExpr(
        "shipment_id",
        "CASE k % 3 WHEN 0 THEN 'fcl' WHEN 1 THEN 'lcl' END AS volume_kind",
        "k % 3 = 2 AS is_air",
        "freight AS ocean_freight_type",
        "freight AS air_freight_type",
        "CASE WHEN o_totalprice >= 10000 THEN freight END AS freight_type",
        "CASE k % 3 WHEN 2 THEN 'Air' WHEN 0 THEN 'Ocean FCL' ELSE 'Ocean LCL' END AS mode_blended",
        "CASE WHEN o_orderstatus <> 'P' THEN 'FINAL destination' ELSE 'In Transit' END AS transportation_status",
        "o_orderpriority <> '4-NOT SPECIFIED' AS wants_freight",
        "r_name AS destination_region",
        "CASE WHEN k % 6 <> 0 THEN int(5 + k % 10) END AS ocean_transit_min",
        "CASE WHEN k % 6 <> 0 THEN int(20 + k % 10) END AS ocean_transit_max",
        "CASE WHEN k % 7 <> 0 THEN int(2 + k % 5) END AS air_transit_min",
        "CASE WHEN k % 7 <> 0 THEN int(12 + k % 5) END AS air_transit_max",
        *[
            f"CASE WHEN k % {missing} <> 0 THEN departed_at + "
            f"make_dt_interval(int({day} + k % {days}), int(k % {hours})) END AS {name}"
            for name, (day, days, hours, missing) in MILESTONES.items()
        ],
    )


_MILESTONE_SQL = ",\n         ".join(
    f"CASE WHEN o_orderkey % {missing} <> 0 THEN departed_at "
    f"+ to_days(CAST({day} + o_orderkey % {days} AS INTEGER)) + to_hours(o_orderkey % {hours}) END AS {name}"
    for name, (day, days, hours, missing) in MILESTONES.items()
)

OTP_SQL = f"""{TIMELINE_SQL}, {REGIONS_SQL},
otp_shipments AS (
  SELECT shipment_id,
         CASE o_orderkey % 3 WHEN 0 THEN 'fcl' WHEN 1 THEN 'lcl' END AS volume_kind,
         o_orderkey % 3 = 2 AS is_air,
         CASE (o_orderkey // 3) % 4 WHEN 0 THEN 'Port to Door' WHEN 1 THEN 'Port to Port'
              WHEN 2 THEN 'Door to Port' ELSE 'Door to Door' END AS ft,
         CASE o_orderkey % 3 WHEN 2 THEN 'Air' WHEN 0 THEN 'Ocean FCL' ELSE 'Ocean LCL' END AS mode_blended,
         o_totalprice >= 10000 AS has_freight_type, o_orderstatus <> 'P' AS arrived,
         o_orderpriority <> '4-NOT SPECIFIED' AS wants_freight, r_name AS destination_region,
         CASE WHEN o_orderkey % 6 <> 0 THEN CAST(5 + o_orderkey % 10 AS INTEGER) END AS ocean_min,
         CASE WHEN o_orderkey % 6 <> 0 THEN CAST(20 + o_orderkey % 10 AS INTEGER) END AS ocean_max,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(2 + o_orderkey % 5 AS INTEGER) END AS air_min,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(12 + o_orderkey % 5 AS INTEGER) END AS air_max,
         {_MILESTONE_SQL}
  FROM orders JOIN timeline ON o_orderkey = shipment_id
  JOIN client_regions ON o_custkey = c_custkey)"""


# Milestone of a shipment: (first day after the first departure, spread in days, one in how many missing).
TRANSIT = {
    "actual_origin_departed_at": (0, 3, 31),
    "actual_departure_port_departed_at": (2, 4, 37),
    "actual_arrival_port_arrived_at": (9, 9, 11),
    "actual_first_delivered_at": (12, 7, 13),
    "actual_in_full_delivered_at": (14, 20, 5),
}


def transit_shipments(t: Tables) -> DataFrame:
    """Orders as shipments: freight type, client, value (one in six unknown) and their transit milestones."""
    labels = ", ".join(f"'{name}'" for name in FREIGHT_TYPES)
    return t.orders.join(timeline(t), F.col("o_orderkey") == F.col("shipment_id")).selectExpr(
        "shipment_id",
        "o_custkey AS client_id",
        "o_orderstatus <> 'P' AS is_live",
        f"CASE WHEN o_orderkey % 17 <> 0 THEN element_at(array({labels}), int(o_orderkey % 4) + 1) END AS freight_type",
        "CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS value",
        "o_orderdate AS keyed_at",
        *[
            f"CASE WHEN o_orderkey % {missing} <> 0 THEN departed_at + make_dt_interval(int({day} + o_orderkey % {days}), "
            f"int(o_orderkey % 24)) END AS {name}"
            for name, (day, days, missing) in TRANSIT.items()
        ],
    )


_TRANSIT_COLUMNS = ",\n         ".join(
    f"CASE WHEN o_orderkey % {missing} <> 0 THEN departed_at + to_days(CAST({day} + o_orderkey % {days} AS INTEGER)) "
    f"+ to_hours(o_orderkey % 24) END AS {name}"
    for name, (day, days, missing) in TRANSIT.items()
)
TRANSIT_SQL = f"""{TIMELINE_SQL},
transit_shipments AS (
  SELECT shipment_id, o_custkey AS client_id, o_orderstatus <> 'P' AS is_live,
         CASE WHEN o_orderkey % 17 <> 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'Port to Door' WHEN 1 THEN 'Port to Port'
              WHEN 2 THEN 'Door to Port' ELSE 'Door to Door' END END AS freight_type,
         CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS value, o_orderdate AS keyed_at,
         {_TRANSIT_COLUMNS}
  FROM orders JOIN timeline ON o_orderkey = shipment_id)"""


def quote_lines(t: Tables) -> DataFrame:
    """One quote per order and line number."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_extendedprice").alias("cost"),
        F.max("l_quantity").alias("quantity"),
        F.min("l_shipdate").alias("shipped_at"),
        F.min("l_returnflag").alias("flag"),
        F.max("l_tax").alias("tax"),
    )


QUOTES_SQL = """quote_lines AS (
  SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS cost, max(l_quantity) AS quantity,
         min(l_shipdate) AS shipped_at, min(l_returnflag) AS flag, max(l_tax) AS tax
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def invoices(t: Tables) -> DataFrame:
    """Order lines as invoices of their order; returned ones count as voided."""
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_id"),
        F.col("l_orderkey").alias("shipment_id"),
        F.when(F.col("l_linenumber") < 7, "Invoice").otherwise("Bill").alias("invoice_type"),
        F.lit("Shipment").alias("invoiceable_type"),
        F.col("l_shipdate").alias("issued_at"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("voided_at"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
        F.col("l_linestatus").alias("issuing_entity"),
        F.col("l_returnflag").alias("currency"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.when(F.col("l_tax") > 0.05, F.col("l_extendedprice")).otherwise(0.0).alias("capital_amount"),
    )


INVOICES_SQL = """invoices AS (
  SELECT l_orderkey * 10 + l_linenumber AS invoice_id, l_orderkey AS shipment_id,
         l_shipdate AS issued_at, l_linestatus AS issuing_entity, l_returnflag AS currency,
         l_extendedprice * (1 - l_discount) AS revenue
  FROM lineitem WHERE l_linenumber < 7 AND l_returnflag <> 'R')"""


def updates(t: Tables) -> DataFrame:
    """Events as milestone updates; every second shipment number has a shipment."""
    return t.events.select(
        F.col("event_id").alias("update_id"),
        (F.col("event_id") * 2).alias("shipment_id"),
        F.col("user_id").alias("leg_id"),
        F.col("event_type").alias("source"),
        F.col("event_type").alias("event_type"),
        F.col("event_type").alias("milestone"),
        F.col("user_id").alias("created_by"),
        F.col("ts").alias("created_at"),
        (F.lit(100.0) - F.col("value")).alias("lead_hours"),
    )


UPDATES_SQL = """updates AS (
  SELECT event_id AS update_id, event_id * 2 AS shipment_id, user_id AS leg_id,
         event_type AS source, event_type, event_type AS milestone, user_id AS created_by,
         ts AS created_at, 100.0 - value AS lead_hours FROM events)"""


def shipment_modes(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("shipment_id"), F.col("o_orderpriority").alias("mode")
    )


def audits(t: Tables) -> DataFrame:
    """Events as an audit log of ready dates: bare values, [before, after] pairs, junk.

    A leg is one kind of event of one user; the value decides the kind of document.
    """
    day = "date_format(date_add(DATE'2024-01-01', int(get_json_object(props, '$.k'))), 'yyyy-MM-dd')"
    return t.events.selectExpr(
        "event_id AS audit_id",
        "concat(user_id, '-', event_type) AS leg_id",
        "CASE WHEN value < 40 THEN 'update' ELSE 'create' END AS action",
        "CASE WHEN value > 200 THEN 'Quote' ELSE 'Leg' END AS audited_type",
        "ts AS changed_at",
        f"""CASE WHEN value < 2 THEN '{{"other":1}}' WHEN value < 6 THEN '{{"ready":"n/a"}}'
            ELSE concat(CASE WHEN value < 40 THEN '{{"ready":["2024-01-01","' ELSE '{{"ready":"' END,
                        {day}, CASE WHEN value < 40 THEN '"]}}' ELSE '"}}' END) END AS changes""",
    )


def audit_legs(t: Tables) -> DataFrame:
    """The legs named in the audit log, with their shipment."""
    return t.events.select("user_id", "event_type").distinct().selectExpr(
        "concat(user_id, '-', event_type) AS leg_id",
        "user_id AS shipment_id",
        "event_type <> 'error' AS from_origin",
    )


def audit_quotes(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("shipment_id"),
        (F.col("o_orderdate") - F.make_dt_interval((F.col("o_orderkey") % 9).cast("int"))).alias("quote_submitted_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("quote_accepted_at"),
    )


AUDITS_SQL = """raw_audits AS (
  SELECT event_id AS audit_id, user_id || '-' || event_type AS leg_id, user_id AS shipment_id,
         CASE WHEN value < 40 THEN 'update' ELSE 'create' END AS action, ts AS changed_at,
         CASE WHEN value >= 6 THEN DATE '2024-01-01' + k END AS change_date
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  WHERE value >= 2 AND value <= 200 AND event_type <> 'error'),
audits AS (
  SELECT a.*, o_orderdate - to_days(CAST(o_orderkey % 9 AS INTEGER)) AS quote_submitted_at, o_orderdate AS quote_accepted_at
  FROM raw_audits a JOIN orders ON o_orderkey = shipment_id
  WHERE o_orderstatus <> 'P')"""

TRAIL_SQL = f"""{AUDITS_SQL},
first_dates AS (
  SELECT leg_id, arg_min(change_date, (changed_at, audit_id)) AS change_date_first
  FROM audits WHERE change_date IS NOT NULL GROUP BY leg_id),
trail AS (
  SELECT audit_id, leg_id, change_date, change_order, change_date_prev, change_date_first,
         change_date - change_date_prev AS days_from_prev,
         CASE WHEN change_order <> 1 THEN change_date - change_date_first END AS days_from_first
  FROM (SELECT *, rank() OVER (PARTITION BY leg_id ORDER BY changed_at) AS change_order,
               lag(change_date) OVER (PARTITION BY leg_id ORDER BY changed_at, audit_id) AS change_date_prev
        FROM audits) LEFT JOIN first_dates USING (leg_id))"""


def lifetimes(t: Tables) -> DataFrame:
    """Customer lifetimes with segment; a year without orders ends a lifetime."""
    from waybill.plans.cohorts import client_lifetimes

    spans = client_lifetimes(t.orders, "o_custkey", "o_orderdate", "2001-08-01")
    named = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return spans.join(named, spans.o_custkey == named.c_custkey).drop("c_custkey")


LIFETIMES_SQL = """lifetimes AS (
  SELECT o_custkey, c_mktsegment AS segment, first_date, last_date,
         (last_date - first_date) // 7 AS lifetime_weeks,
         DATE '2001-08-01' - last_date > 182 AS has_died,
         CASE WHEN DATE '2001-08-01' - last_date > 182 THEN last_date END AS churn_date
  FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_date,
               CAST(max(o_orderdate) AS DATE) AS last_date FROM orders GROUP BY o_custkey)
  JOIN customer ON o_custkey = c_custkey)"""


def money(c: str) -> Column:
    """Exact sums: two-decimal money as a decimal, so the order of addition is irrelevant."""
    return F.col(c).cast("decimal(18,2)")


def quarterly(t: Tables, by_segment: bool = True) -> DataFrame:
    """Quarterly order value, one series per market segment or a single one."""
    from waybill.operators.timeseries import to_series

    value = F.sum(money("o_totalprice")).cast("double")
    if not by_segment:
        return to_series(t.orders, "o_orderdate", value, "quarter", F.lit("all"))
    # Sums per customer and quarter first: the join then meets far fewer rows.
    per_client = t.orders.groupBy(
        "o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("quarter")
    ).agg(F.sum(money("o_totalprice")).alias("amount"))
    named = t.customer.select("c_custkey", "c_mktsegment")
    joined = per_client.join(named, per_client.o_custkey == named.c_custkey)
    return to_series(
        joined, "quarter", F.sum("amount").cast("double"), "quarter", F.col("c_mktsegment")
    )


SERIES_SQL = """series AS (
  SELECT c_mktsegment AS series_id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS ts,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
