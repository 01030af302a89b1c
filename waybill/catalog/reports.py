"""Registered logistics reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog import views as v
from waybill.catalog.registry import publish, query, r
from waybill.operators.staging import staged
from waybill.plans import attach, bookings, changes, cohorts, exposure, invoicing, milestones, otp
from waybill.sources import calendar


def d(expression: str) -> str:
    """SQL text for a date as ISO text."""
    return f"strftime({expression}, '%Y-%m-%d')"


def ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


@query(f"""
WITH {v.TIMELINE_SQL}
SELECT o_orderpriority AS mode, year(o_orderdate) AS year, month(o_orderdate) AS month,
       count(*) AS n,
       {r("avg(CASE WHEN delivered_at <= o_orderdate + INTERVAL 730 DAY THEN 1.0 ELSE 0.0 END)")} AS otp_rate
FROM orders JOIN timeline ON o_orderkey = shipment_id GROUP BY 1, 2, 3
""")
def otp_rate_by_mode_month(t):
    shipped = t.orders.join(v.timeline(t), F.col("o_orderkey") == F.col("shipment_id"))
    due = F.col("o_orderdate") + F.make_dt_interval(F.lit(730))
    report = shipped.select(
        F.col("o_orderpriority").alias("mode"),
        "o_orderdate",
        (F.col("delivered_at") <= due).alias("on_time"),
    )
    return publish(otp.otp_rate(report, "mode", "o_orderdate", F.col("on_time")))


_AIR_LOCAL = """coalesce(actual_deconsolidation_ready_for_pickup_at_local,
           actual_deconsolidation_departed_at_local, actual_arrival_port_departed_at_local)"""
_AIR_END = """coalesce(actual_deconsolidation_ready_for_pickup_at,
           actual_deconsolidation_departed_at, actual_arrival_port_departed_at)"""
_TRIP_SQL = f"""{v.OTP_SQL},
trip AS (
  SELECT *,
    CASE WHEN volume_kind = 'fcl' AND ft IN ('Port to Door', 'Port to Port') THEN actual_departure_port_arrived_at
         WHEN volume_kind = 'lcl' AND ft IN ('Port to Door', 'Port to Port') THEN actual_consolidation_arrived_at
         WHEN volume_kind IN ('fcl', 'lcl') THEN actual_cargo_ready_date_local
         WHEN is_air AND ft IN ('Port to Door', 'Port to Port')
           THEN coalesce(actual_consolidation_arrived_at, actual_departure_port_arrived_at)
         WHEN is_air THEN actual_cargo_ready_date_local END AS start_at,
    CASE WHEN ft IN ('Port to Door', 'Door to Door')
           THEN coalesce(actual_in_full_delivered_at, scheduled_in_full_delivered_at)
         WHEN volume_kind = 'fcl' THEN coalesce(actual_final_port_departed_at, scheduled_final_port_departed_at)
         WHEN volume_kind = 'lcl' AND ft = 'Port to Port'
           THEN coalesce(actual_deconsolidation_departed_at, scheduled_deconsolidation_departed_at)
         WHEN volume_kind = 'lcl' THEN scheduled_deconsolidation_departed_at
         ELSE coalesce({_AIR_END}, scheduled_deconsolidation_departed_at,
                       scheduled_arrival_port_departed_at) END AS completed_at,
    CASE WHEN ft IN ('Port to Door', 'Door to Door') THEN actual_in_full_delivered_at_local
         WHEN volume_kind = 'fcl' THEN actual_final_port_departed_at_local
         WHEN volume_kind = 'lcl' AND ft = 'Port to Port' THEN actual_deconsolidation_departed_at_local
         WHEN volume_kind = 'lcl' THEN scheduled_deconsolidation_departed_at_local
         ELSE {_AIR_LOCAL} END AS local_at,
    CASE WHEN ft IN ('Port to Door', 'Door to Door') THEN actual_in_full_delivered_at
         WHEN volume_kind = 'fcl' THEN actual_final_port_departed_at
         WHEN volume_kind = 'lcl' THEN actual_deconsolidation_departed_at
         ELSE {_AIR_END} END AS end_at
  FROM otp_shipments),
windowed AS (
  SELECT *, CAST(completed_at AS DATE) AS completion_date, CAST(local_at AS DATE) AS local_date,
         date_diff('hour', start_at, end_at) / 24.0 AS transit_days,
         CAST(start_at AS DATE) + CASE WHEN is_air THEN air_min ELSE ocean_min END AS opens,
         CAST(start_at AS DATE) + CASE WHEN is_air THEN air_max ELSE ocean_max END AS closes
  FROM trip),
status AS (
  SELECT *,
    CASE WHEN transit_days IS NOT NULL AND ocean_min IS NOT NULL AND local_date BETWEEN opens AND closes THEN 'True'
         WHEN transit_days IS NOT NULL AND is_air AND air_min IS NOT NULL
              AND local_date BETWEEN opens AND closes THEN 'True'
         WHEN transit_days IS NULL AND ocean_min IS NOT NULL AND DATE '1998-07-15' < opens THEN 'Not Eligible'
         WHEN transit_days IS NOT NULL AND ocean_min IS NOT NULL AND DATE '1998-07-15' < opens THEN 'Not Eligible'
         ELSE 'False' END AS transit_on_time,
    CASE WHEN
      actual_first_port_arrived_at_local IS NOT NULL AND actual_first_port_departed_at_local IS NOT NULL
      AND actual_final_port_arrived_at_local IS NOT NULL AND actual_final_port_departed_at_local IS NOT NULL
      AND (volume_kind IS NOT DISTINCT FROM 'fcl' OR (
           actual_consolidation_arrived_at_local IS NOT NULL AND actual_consolidation_departed_at_local IS NOT NULL
           AND actual_deconsolidation_arrived_at_local IS NOT NULL
           AND actual_deconsolidation_departed_at_local IS NOT NULL))
      AND (NOT (ft IN ('Door to Door', 'Door to Port') OR (volume_kind = 'fcl' AND ft = 'Port to Door')) IS TRUE
           OR (actual_cargo_ready_date_local IS NOT NULL AND actual_origin_departed_at_local IS NOT NULL))
      AND (ft NOT IN ('Port to Door', 'Door to Door') OR actual_in_full_delivered_at_local IS NOT NULL
           OR (volume_kind IS DISTINCT FROM 'fcl' AND actual_first_delivered_at_local IS NOT NULL))
      THEN 'Yes' ELSE 'No' END AS milestones_complete
  FROM windowed)"""

_AS_OF = "1998-07-15"


@query(f"""
WITH {_TRIP_SQL}
SELECT shipment_id, {d("completion_date")} AS completion_date, {d("local_date")} AS local_completion_date,
       {ts("start_at")} AS start_at, {r("transit_days")} AS transit_days FROM windowed
""")
def responsible_completion(t):
    trip = otp.responsible_trip(v.otp_shipments(t))
    return publish(
        trip.select(
            "shipment_id", "completion_date", "local_completion_date", "start_at", "transit_days"
        )
    )


@query(f"""
WITH {_TRIP_SQL}
SELECT shipment_id, mode_blended, transit_on_time FROM status
""")
def otp_status(t):
    status = otp.otp_status(v.otp_shipments(t), _AS_OF)
    return status.select("shipment_id", "mode_blended", "transit_on_time")


@query(f"""
WITH {_TRIP_SQL}
SELECT shipment_id, milestones_complete FROM status
""")
def milestones_complete(t):
    status = otp.otp_status(v.otp_shipments(t), _AS_OF)
    return status.select("shipment_id", "milestones_complete")


_REPORT_SQL = f"""{_TRIP_SQL},
report AS (
  SELECT DISTINCT shipment_id, completion_date, mode_blended, transit_on_time, milestones_complete
  FROM status
  WHERE has_freight_type AND arrived AND wants_freight AND upper(destination_region) = 'EUROPE'
    AND completion_date >= DATE '1998-04-01' AND completion_date < DATE '1998-10-01')"""


def _report(t):
    status = otp.otp_status(v.otp_shipments(t), _AS_OF)
    return otp.otp_report(
        status,
        _AS_OF,
        "Europe",
        "Final Destination",
        ["shipment_id", "completion_date", "mode_blended", "transit_on_time", "milestones_complete"],
    )


@query(f"""
WITH {_REPORT_SQL}
SELECT shipment_id, {d("completion_date")} AS completion_date, mode_blended, transit_on_time,
       milestones_complete FROM report
""")
def otp_report(t):
    return publish(_report(t))


@query(f"""
WITH {_REPORT_SQL}
SELECT mode_blended AS mode, year(completion_date) AS year, month(completion_date) AS month, count(*) AS n,
       {r("avg(CASE WHEN transit_on_time = 'True' THEN 1.0 ELSE 0.0 END)")} AS otp_rate
FROM report WHERE milestones_complete = 'Yes' GROUP BY 1, 2, 3
""")
def otp_rate_from_status(t):
    return publish(otp.otp_rate_from_status(_report(t), "mode_blended", "completion_date"))


@query(f"""
WITH {v.QUOTES_SQL}
SELECT l_orderkey * 10 + l_linenumber AS quote_id, l_orderkey AS shipment_id,
       CASE WHEN l_orderkey % 3 = 0 THEN 'model' WHEN l_orderkey % 3 = 1 THEN 'manual' END AS quote_source,
       l_linenumber + CASE WHEN quantity > 25 THEN CAST(quantity AS BIGINT) ELSE 0 END
         + CASE WHEN tax > 0.02 THEN 3 ELSE 0 END AS total_transit_days,
       CASE WHEN tax > 0.03 THEN l_linenumber + 5 ELSE 0 END AS predicted_total_transit_days
FROM quote_lines WHERE flag <> 'R'
""")
def quoted_transit_total(t):
    number = "l_orderkey * 10 + l_linenumber AS quote_id"
    lines = v.quote_lines(t)
    times = lines.selectExpr(
        number,
        "l_orderkey % 3 AS data_source",
        "bigint(l_linenumber) AS origin_days",
        "bigint(NULL) AS origin_dwell_days",
        "CASE WHEN quantity > 25 THEN bigint(quantity) END AS port_to_port_days",
        "CASE WHEN tax > 0.02D THEN 3L END AS destination_dwell_days",
        "bigint(NULL) AS destination_days",
    )
    quotes = lines.selectExpr(
        number,
        "l_orderkey AS shipment_id",
        "shipped_at AS accepted_at",
        "CASE WHEN flag = 'R' THEN shipped_at END AS voided_at",
    )
    predicted = lines.where("tax > 0.03D").selectExpr(
        number,
        "bigint(l_linenumber) AS origin_days",
        "bigint(NULL) AS origin_dwell_days",
        "5L AS port_to_port_days",
        "bigint(NULL) AS destination_dwell_days",
        "bigint(NULL) AS destination_days",
    )
    sources = t.spark.sql(
        "SELECT * FROM VALUES (0L, 'model'), (1L, 'manual') AS s(data_source, quote_source)"
    )
    return otp.quoted_transit_total(times, quotes, predicted, sources).select(
        "quote_id",
        "shipment_id",
        "quote_source",
        "total_transit_days",
        "predicted_total_transit_days",
    )


@query(f"""
WITH {v.QUOTES_SQL}, q AS (
  SELECT l_orderkey * 10 + l_linenumber AS quote_id, o_orderkey AS shipment_id, o_custkey AS client_id,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS accepted, o_orderstatus <> 'O' AS is_live,
         cost, CASE WHEN o_orderkey % 2 = 0 THEN 'Ocean' ELSE 'Air' END AS mode,
         CASE WHEN l_linenumber % 2 = 0 THEN 'LCL' ELSE 'Not LCL' END AS lcl,
         o_orderkey % 5 = 0 AS acceptor_is_staff, quantity,
         o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' AS autobooked, l_linenumber,
         date_diff('hour', o_orderdate, shipped_at + to_hours(l_linenumber)) AS share_hours,
         flag = 'A' AS is_air_quote
  FROM quote_lines JOIN orders ON o_orderkey = l_orderkey)
SELECT quote_id, shipment_id, client_id,
       CASE WHEN autobooked THEN 'autobook' WHEN acceptor_is_staff THEN 'staff'
            ELSE 'client' END AS acceptor,
       CASE WHEN mode = 'Ocean' AND lcl = 'LCL' THEN 'Ocean LCL' WHEN mode = 'Ocean' THEN 'Ocean FCL'
            ELSE mode END AS mode_blended,
       is_air_quote,
       {r("max(CASE WHEN accepted IS NOT NULL THEN cost END) OVER s", 2)} AS won_cost,
       {r("min(CASE WHEN NOT is_live THEN cost END) OVER s", 2)} AS lost_cost,
       {r("coalesce(max(CASE WHEN accepted IS NOT NULL THEN cost END) OVER s, 0) + coalesce(min(CASE WHEN NOT is_live THEN cost END) OVER s, 0)", 2)} AS total_cost,
       max(quantity) OVER s AS quoted_chargeable_weight,
       max(l_linenumber + 10) OVER s AS quoted_transit_max, min(l_linenumber) OVER s AS quoted_transit_min,
       max(l_linenumber * 2) OVER s AS quoted_origin_days, min(share_hours) OVER s AS hours_to_share,
       {d("min(CASE WHEN mode = 'Air' THEN accepted END) OVER c")} AS first_air_acceptance,
       {d("max(accepted) OVER c")} AS last_acceptance
FROM q WINDOW s AS (PARTITION BY shipment_id), c AS (PARTITION BY client_id)
""")
def quote_enrichment(t):
    # Quotes, items and times are all read from these rows, so lines and orders are joined once and kept.
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    lines = staged(
        v.quote_lines(t).join(orders, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey", "tax")
    )
    number = "o_orderkey * 10 + l_linenumber AS quote_id"
    quotes = lines.selectExpr(
        number,
        "o_orderkey AS shipment_id",
        "o_custkey AS client_id",
        "CASE WHEN o_orderstatus <> 'P' THEN date(o_orderdate) END AS quote_accepted_date",
        "o_orderstatus <> 'O' AS is_live",
        "cost",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'Ocean' ELSE 'Air' END AS mode",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'LCL' ELSE 'Not LCL' END AS lcl",
        "o_orderkey % 5 = 0 AS acceptor_is_staff",
        "quantity AS chargeable_weight",
        "quantity AS teu",
        "quantity AS volume",
        "l_linenumber + 10 AS transit_time_max",
        "l_linenumber AS transit_time_min",
        "o_orderdate AS requested_at",
        "shipped_at + make_dt_interval(0, l_linenumber) AS submitted_at",
    )
    items = lines.selectExpr(number, "CASE WHEN flag = 'A' THEN 1 ELSE 2 END AS template_id")
    # An order that comes twice repeats its quotes, not their times, which are dealt by the key of their join.
    once = lines.selectExpr(number, "o_orderkey", "l_linenumber").repartition("quote_id").distinct()
    times = once.selectExpr(
        "quote_id",
        "l_linenumber * 2 AS origin_days",
        "l_linenumber AS destination_days",
        "l_linenumber AS port_to_port_days",
    )
    booked = t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'").select(
        F.col("o_orderkey").alias("shipment_id"), F.col("o_custkey").alias("client_id")
    )
    out = otp.quote_enrichment(quotes, items, times, booked, ("autobook", "staff", "client"))
    return publish(
        out.select(
            "quote_id",
            "shipment_id",
            "client_id",
            "acceptor",
            "mode_blended",
            "is_air_quote",
            "won_cost",
            "lost_cost",
            "total_cost",
            "quoted_chargeable_weight",
            "quoted_transit_max",
            "quoted_transit_min",
            "quoted_origin_days",
            "hours_to_share",
            "first_air_acceptance",
            "last_acceptance",
        ),
        2,
    )


def _invoice_timeliness(t):
    first_delivery = v.timeline(t).select(
        "shipment_id", F.col("departed_at").alias("delivered_at"), F.col("n_lines").alias("n_rows")
    )
    known = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("shipment_id"))
    return invoicing.invoice_timeliness(v.invoices(t), first_delivery, known, "1996-06-01")


_TIMELINESS_SQL = f"""{v.TIMELINE_SQL}, {v.INVOICES_SQL},
shared AS (
  SELECT invoice_id, issued_at AS shared_at, departed_at + INTERVAL 3 DAY AS share_due_at
  FROM invoices JOIN timeline USING (shipment_id) JOIN orders ON o_orderkey = shipment_id
  WHERE o_orderstatus <> 'P' AND issued_at >= TIMESTAMP '1996-06-01')"""


@query(f"""
WITH {_TIMELINESS_SQL}
SELECT invoice_id, {ts("shared_at")} AS shared_at, {ts("share_due_at")} AS share_due_at,
       share_due_at >= shared_at AS on_time,
       CAST(CAST(date_diff('second', share_due_at, shared_at) / 86400.0 AS DECIMAL(16,4)) AS DOUBLE) AS days_to_share
FROM shared
""")
def invoice_timeliness(t):
    return publish(_invoice_timeliness(t))


@query(f"""
WITH {_TIMELINESS_SQL}
SELECT year(shared_at) AS year, count(*) AS n,
       {r("avg(CASE WHEN share_due_at >= shared_at THEN 1.0 ELSE 0.0 END)")} AS on_time_rate
FROM shared GROUP BY 1
""")
def invoice_on_time_rate(t):
    from waybill.operators.quality import rate

    out = _invoice_timeliness(t).withColumn("year", F.year("shared_at"))
    return publish(rate(out, ["year"], F.col("on_time"), "on_time_rate"))


@query(f"""
WITH {_TIMELINESS_SQL.replace("JOIN orders ON o_orderkey = shipment_id", "JOIN lineitem ON l_orderkey = shipment_id").replace("o_orderstatus <> 'P'", "l_linenumber <= 3")},
once AS (
  SELECT issued_at AS shared_at FROM invoices JOIN timeline USING (shipment_id)
  WHERE issued_at >= TIMESTAMP '1996-06-01' AND shipment_id IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 3))
SELECT s.year, rows_kept, rows_once, {r("on_time_rate")} AS on_time_rate FROM
  (SELECT year(shared_at) AS year, count(*) AS rows_kept, avg(CASE WHEN share_due_at >= shared_at THEN 1.0 ELSE 0.0 END) AS on_time_rate
   FROM shared GROUP BY 1) s
  JOIN (SELECT year(shared_at) AS year, count(*) AS rows_once FROM once GROUP BY 1) o ON s.year = o.year
""")
def invoice_fan_out(t):
    """A shipment that the list names several times repeats its invoices; as an existence check it does not."""
    first_delivery = v.timeline(t).select("shipment_id", F.col("departed_at").alias("delivered_at"))
    listed = t.lineitem.where("l_linenumber <= 3").select(F.col("l_orderkey").alias("shipment_id"))
    args = (v.invoices(t), first_delivery, listed, "1996-06-01")
    year = F.year("shared_at").alias("year")
    kept = invoicing.invoice_timeliness(*args).groupBy(year).agg(
        F.count(F.lit(1)).alias("rows_kept"), F.avg(F.col("on_time").cast("double")).alias("on_time_rate")
    )
    once = invoicing.invoice_timeliness(*args, exists_only=True).groupBy(year).agg(F.count(F.lit(1)).alias("rows_once"))
    return publish(kept.join(once, "year").select("year", "rows_kept", "rows_once", "on_time_rate"))


@query(f"""
WITH {v.INVOICES_SQL}
SELECT invoice_id, issuing_entity, currency, {r("revenue", 4)} AS revenue
FROM invoices WHERE issued_at >= TIMESTAMP '2000-01-01' AND issued_at < TIMESTAMP '2000-07-01'
""")
def invoice_details(t):
    return publish(invoicing.invoice_details(v.invoices(t), "2000-01-01", "2000-07-01"), 4)


@query(f"""
WITH once AS (
  SELECT o_custkey, o_orderdate, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate IS NOT NULL)
SELECT strftime(CAST(o_orderdate AS DATE) + CAST(1 - dayofweek(o_orderdate) AS INTEGER), '%Y-%m-%d') AS week,
       o_orderpriority AS service_level, count(*) AS bookings
FROM once WHERE rn = 1 GROUP BY 1, 2
""")
def weekly_first_orders(t):
    return publish(
        bookings.weekly_bookings(
            t.orders,
            "o_custkey",
            ["o_orderdate", "o_orderkey"],
            "o_orderdate",
            "o_orderpriority",
            ["1-URGENT", "2-HIGH"],
        )
    )


_YEAR = ("1999-01-01", "1999-12-31")


def _collateral(t):
    financed = t.lineitem.where("l_tax > 0.05").select("l_orderkey").distinct()
    known = F.when(F.col("l_linenumber") < 5, F.col("l_extendedprice"))
    orders = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipments = lines.join(financed, "l_orderkey", "left_semi").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("shipment_id"),
        F.col("o_custkey").alias("client_id"),
        known.alias("value"),
        F.col("o_orderdate").alias("start_at"),
        F.col("l_shipdate").alias("end_at"),
    )
    everyone = t.orders.select("o_orderkey", F.col("o_custkey").alias("client_id"))
    values = t.lineitem.join(everyone, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "client_id", known.alias("value"), F.col("l_shipdate").alias("keyed_at")
    )
    priced = exposure.imputed_values(shipments, values, _YEAR)
    days = calendar(t.spark, *_YEAR)
    return exposure.daily_collateral(priced, days, *_YEAR)


def _outstanding(t):
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    day = F.col("o_orderdate").cast("date")
    repayments = t.orders.select(
        k.alias("origination_id"),
        day.alias("outlaid_on"),
        (status == "F").alias("is_collected"),
        (status == "P").alias("is_charged_off"),
        F.when(status == "F", F.date_add(day, (k % 90).cast("int"))).alias("repaid_on"),
        F.when(status == "P", F.date_add(day, 120)).alias("charged_off_on"),
        (F.col("o_totalprice") < 20000).alias("is_deleted"),
        v.money("o_totalprice").alias("principal"),
    )
    originations = t.orders.select(
        k.alias("origination_id"), (F.col("o_orderpriority") != "5-LOW").alias("is_live_origination")
    )
    days = calendar(t.spark, *_YEAR)
    return exposure.daily_outstanding(repayments, originations, days, *_YEAR)


_DAYS_SQL = """days AS (
  SELECT CAST(g AS DATE) AS day FROM generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY) AS s(g))"""
_COLLATERAL_SQL = f"""known AS (
  SELECT l_orderkey, l_shipdate, o_custkey, o_orderdate, o_orderstatus,
         CASE WHEN l_linenumber < 5 THEN l_extendedprice END AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
medians AS (
  SELECT o_custkey, median(value) AS mid FROM known
  WHERE l_shipdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1),
shipments AS (
  SELECT o_orderdate AS start_at, l_shipdate AS end_at, CAST(coalesce(value, mid) AS DECIMAL(28,4)) AS value
  FROM known LEFT JOIN medians USING (o_custkey)
  WHERE o_orderstatus <> 'P' AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.05)),
collateral AS (
  SELECT day, CAST(round(sum(CASE WHEN day BETWEEN start_at AND end_at THEN value ELSE 0 END), 2) AS DOUBLE) AS v
  FROM days CROSS JOIN shipments GROUP BY day)"""
_OUTSTANDING_SQL = """repay AS (
  SELECT CAST(o_orderdate AS DATE) AS outlaid, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(28,4)) AS principal,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS repaid, CAST(o_orderdate AS DATE) + 120 AS charged
  FROM orders WHERE o_totalprice >= 20000 AND o_orderpriority <> '5-LOW'),
outstanding AS (
  SELECT day, CAST(sum(CASE WHEN outlaid <= day AND ((st = 'F' AND repaid > day) OR (st = 'P' AND charged > day)
                                 OR st = 'O') THEN principal ELSE 0 END) AS DOUBLE) AS v
  FROM days CROSS JOIN repay GROUP BY day)"""


@query(f"""
WITH {_DAYS_SQL}, {_COLLATERAL_SQL}
SELECT {d("day")} AS date_day, v AS in_transit_value FROM collateral
""")
def daily_exposure(t):
    return publish(_collateral(t))


_TRANSIT_SQL = f"""{v.TRANSIT_SQL},
medians AS (SELECT client_id, median(value) AS mid FROM transit_shipments
            WHERE keyed_at BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1),
moved AS (
  SELECT CASE WHEN freight_type IN ('Door to Door', 'Door to Port') THEN actual_origin_departed_at
              WHEN freight_type IN ('Port to Door', 'Port to Port') THEN actual_departure_port_departed_at END AS start_at,
         coalesce(CASE WHEN freight_type IN ('Door to Door', 'Port to Door') THEN actual_in_full_delivered_at
                       WHEN freight_type IN ('Door to Port', 'Port to Port') THEN actual_arrival_port_arrived_at END,
                  actual_first_delivered_at, actual_arrival_port_arrived_at) AS end_at,
         CAST(coalesce(value, mid) AS DECIMAL(28,4)) AS value
  FROM transit_shipments LEFT JOIN medians USING (client_id)
  WHERE is_live AND shipment_id IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber < 7 AND l_returnflag <> 'R' AND l_tax > 0.05
                                    AND l_extendedprice > 0))"""


@query(f"""
WITH {_DAYS_SQL}, {_TRANSIT_SQL}
SELECT {d("day")} AS date_day, CAST(round(sum(CASE WHEN day BETWEEN start_at AND end_at THEN value ELSE 0 END), 2) AS DOUBLE) AS in_transit_value
FROM days CROSS JOIN moved GROUP BY day
""")
def transit_collateral(t):
    shipments = v.transit_shipments(t)
    values = shipments.select("client_id", "value", "keyed_at")
    days = calendar(t.spark, *_YEAR)
    return publish(
        exposure.transit_collateral(shipments, v.invoices(t), values, days, *_YEAR, reference=_YEAR)
    )


@query(f"""
WITH {_DAYS_SQL}, {_OUTSTANDING_SQL}
SELECT {d("day")} AS date_day, v AS outstanding_principal FROM outstanding
""")
def daily_outstanding(t):
    return publish(_outstanding(t))


@query(f"""
WITH {_DAYS_SQL}, {_COLLATERAL_SQL}, {_OUTSTANDING_SQL}
SELECT {d("day")} AS date_day, c.v AS in_transit_value, o.v AS outstanding_principal
FROM days LEFT JOIN collateral c USING (day) LEFT JOIN outstanding o USING (day)
""")
def exposure_report(t):
    return publish(
        exposure.exposure_report(calendar(t.spark, *_YEAR), [_collateral(t), _outstanding(t)])
    )


@query(f"""
SELECT o_custkey, c_mktsegment AS segment, year(o_orderdate) AS year, month(o_orderdate) AS month,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_attached,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_base,
       {r("sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / nullif(CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE), 0)")} AS attach_rate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2, 3, 4
""")
def monthly_attach_rate(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("a"),
        F.count_if(F.col("l_linestatus") == "O").alias("b"),
    )
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    monthly = attach.attach_rate(
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")),
        ["o_custkey"],
        "o_orderdate",
        F.col("a"),
        F.col("b"),
    )
    named = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    return publish(
        monthly.join(named, "o_custkey").select(
            "o_custkey", "segment", "year", "month", "n_attached", "n_base", "attach_rate"
        )
    )


@query(f"""
WITH {v.UPDATES_SQL}
SELECT update_id, shipment_id, o_orderpriority AS mode, c_mktsegment AS leg_mode, event_type, created_by,
       {r("lead_hours")} AS lead_hours
FROM updates LEFT JOIN customer ON c_custkey = leg_id LEFT JOIN orders ON o_orderkey = shipment_id
WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at <= TIMESTAMP '2024-01-20'
  AND event_type IN ('click', 'view')
""")
def milestone_updates(t):
    legs = t.customer.select(
        F.col("c_custkey").alias("leg_id"), F.col("c_mktsegment").alias("leg_mode")
    )
    out = milestones.milestone_updates(
        v.updates(t), legs, v.shipment_modes(t), "2024-01-05", "2024-01-20", ["click", "view"]
    )
    columns = ["update_id", "shipment_id", "mode", "leg_mode", "event_type", "created_by", "lead_hours"]
    return publish(out.select(*columns)).orderBy(
        F.desc_nulls_first("shipment_id"), "update_id"
    )


@query(f"""
WITH {v.UPDATES_SQL},
kept AS (SELECT source FROM updates JOIN orders ON o_orderkey = shipment_id
         WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND lead_hours > 0)
SELECT source AS value, count(*) AS n, {r("count(*) / CAST((SELECT count(*) FROM kept) AS DOUBLE)")} AS share
FROM kept GROUP BY source
""")
def update_source_share(t):
    joined = v.updates(t).join(v.shipment_modes(t), "shipment_id")
    urgent = F.col("mode") == "1-URGENT"
    medium = F.col("mode") == "3-MEDIUM"
    actual = F.col("lead_hours") > 0
    return publish(milestones.source_share(joined, (urgent | medium) & actual, "source"))


@query(f"""
WITH {v.UPDATES_SQL},
kinds AS (
  SELECT CASE WHEN source IN ('error', 'click') THEN 'bot'
              WHEN source IN ('view', 'purchase') THEN
                CASE created_by % 4 WHEN 0 THEN 'individual' WHEN 1 THEN 'shared' WHEN 2 THEN 'group' END
         END AS user_kind, lead_hours
  FROM updates)
SELECT user_kind, count(*) AS updates, {r("avg(lead_hours)")} AS mean_lead_hours
FROM kinds WHERE user_kind IS NOT NULL AND lead_hours < 0 AND lead_hours > -336 GROUP BY 1
""")
def update_speed_by_user_type(t):
    k = F.col("created_by") % 4
    users = (
        v.updates(t)
        .select("created_by")
        .distinct()
        .withColumn(
            "user_type",
            F.when(k == 0, "individual").when(k == 1, "shared").when(k == 2, "group"),
        )
    )
    return publish(
        milestones.update_speed(v.updates(t), users, ["error", "click"], ["view", "purchase"])
    )


@query(f"""
WITH {v.UPDATES_SQL},
modes AS (SELECT o_orderpriority AS mode, count(DISTINCT o_orderkey) AS shipments FROM orders GROUP BY 1),
expected AS (SELECT unnest(['click', 'error', 'purchase', 'refund']) AS milestone),
present AS (SELECT o_orderpriority AS mode, milestone, count(DISTINCT shipment_id) AS present
            FROM updates JOIN orders ON o_orderkey = shipment_id GROUP BY 1, 2)
SELECT mode, milestone, shipments, shipments - coalesce(present, 0) AS missing,
       {r("(shipments - coalesce(present, 0)) / CAST(shipments AS DOUBLE)")} AS missing_share
FROM modes CROSS JOIN expected LEFT JOIN present USING (mode, milestone)
""")
def missing_milestones(t):
    return publish(
        milestones.missing_milestones(
            v.updates(t), v.shipment_modes(t), ["click", "error", "purchase", "refund"]
        )
    )


@query(f"""
WITH {v.UPDATES_SQL},
late AS (SELECT o_orderpriority AS mode, lead_hours, update_id, source FROM updates
         JOIN orders ON o_orderkey = shipment_id WHERE lead_hours < 0)
SELECT mode, updates, {r("lead_hours")} AS lead_hours, update_id, source FROM (
  SELECT *, count(*) OVER (PARTITION BY mode) AS updates,
         row_number() OVER (PARTITION BY mode ORDER BY lead_hours DESC, update_id DESC) AS rn FROM late)
WHERE rn = 1
""")
def fastest_update_by_mode(t):
    return publish(
        milestones.fastest_update(v.updates(t).join(v.shipment_modes(t), "shipment_id", "left"))
    )


def _trail(t):
    extract = changes.change_extract(
        v.audits(t), v.audit_legs(t), v.audit_quotes(t), "ready", "2024-01-01", "2024-12-31", ["Leg"]
    )
    return changes.change_trail(extract)


@query(f"""
WITH {v.AUDITS_SQL}
SELECT audit_id, leg_id, action, shipment_id, {ts("changed_at")} AS changed_at,
       coalesce({d("change_date")}, 'n/a') AS new_value, {ts("quote_submitted_at")} AS quote_submitted_at,
       {ts("quote_accepted_at")} AS quote_accepted_at FROM audits
""")
def change_extract(t):
    return publish(
        changes.change_extract(
            v.audits(t),
            v.audit_legs(t),
            v.audit_quotes(t),
            "ready",
            "2024-01-01",
            "2024-12-31",
            ["Leg"],
        )
    )


@query(f"""
WITH {v.AUDITS_SQL}, n AS (SELECT leg_id, count(*) AS n_changes FROM audits GROUP BY 1)
SELECT n_changes, count(*) AS keys, {r("count(*) / (SELECT count(*) FROM n)::DOUBLE")} AS share FROM n GROUP BY 1
ORDER BY keys DESC, n_changes LIMIT 6
""")
def changes_per_leg(t):
    extract = changes.change_extract(
        v.audits(t), v.audit_legs(t), v.audit_quotes(t), "ready", "2024-01-01", "2024-12-31", ["Leg"]
    )
    return publish(changes.changes_per_key(extract, top=6))


@query(f"""
WITH {v.TRAIL_SQL}
SELECT audit_id, leg_id, {d("change_date")} AS change_date, change_order, {d("change_date_prev")} AS change_date_prev,
       {d("change_date_first")} AS change_date_first, days_from_prev, days_from_first FROM trail
""")
def change_trail(t):
    return publish(
        _trail(t).select(
            "audit_id",
            "leg_id",
            "change_date",
            "change_order",
            "change_date_prev",
            "change_date_first",
            "days_from_prev",
            "days_from_first",
        )
    )


@query(f"""
WITH {v.TRAIL_SQL}
SELECT change_order, count(*) AS changes, {r("avg(days_from_first)")} AS mean_days_from_first
FROM trail GROUP BY 1
""")
def change_by_order(t):
    return publish(changes.change_by_order(_trail(t)))


@query(f"""
WITH {v.TRAIL_SQL}
SELECT change_order, {r("quantile_cont(days_from_first, 0.25)")} AS q25,
       {r("quantile_cont(days_from_first, 0.5)")} AS q50, {r("quantile_cont(days_from_first, 0.75)")} AS q75
FROM trail WHERE days_from_first IS NOT NULL GROUP BY 1
""")
def change_trail_quantiles(t):
    return publish(changes.change_quantiles(_trail(t)))


@query(f"""
WITH {v.AUDITS_SQL}, n AS (SELECT leg_id, count(*) AS n FROM audits GROUP BY 1)
SELECT count(*) AS n_keys, {r("avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END)")} AS share_repeated FROM n
""")
def changed_more_than_once(t):
    from waybill.operators.quality import repeated_share

    extract = changes.change_extract(
        v.audits(t), v.audit_legs(t), v.audit_quotes(t), "ready", "2024-01-01", "2024-12-31", ["Leg"]
    )
    return publish(repeated_share(extract, "leg_id"))


@query(f"""
WITH {v.REGIONS_SQL}
SELECT o_orderkey AS shipment_id, {d("o_orderdate")} AS accepted_at, r_name AS tradelane, o_orderpriority AS mode
FROM orders JOIN client_regions ON o_custkey = c_custkey
WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) > DATE '1998-12-31'
""")
def shipment_mode_tradelane(t):
    shipments = t.orders.select(
        F.col("o_orderkey").alias("shipment_id"),
        F.col("o_orderdate").alias("accepted_at"),
        (F.col("o_orderstatus") != "P").alias("is_live"),
        F.col("o_orderpriority").alias("mode"),
        F.col("o_custkey"),
    )
    # The tradelane belongs to the client, so attributes meet shipments on the client key.
    attributes = v.client_regions(t).select(
        F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("tradelane")
    )
    out = bookings.mode_tradelane(shipments, attributes, "1998-12-31", key="o_custkey")
    return publish(out.withColumn("accepted_at", F.col("accepted_at").cast("date")))


@query(f"""
WITH {v.LIFETIMES_SQL}
SELECT o_custkey, segment, lifetime_weeks, has_died, {d("churn_date")} AS churn_date
FROM lifetimes WHERE segment = 'BUILDING' AND year(first_date) = 1995
""")
def cohort_extract(t):
    return publish(
        cohorts.cohort(v.lifetimes(t), "BUILDING", 1995).select(
            "o_custkey", "segment", "lifetime_weeks", "has_died", "churn_date"
        )
    )
