"""Report rules on hand-made rows: one per rule cell, branch and NULL case."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from waybill import catalog
from waybill.catalog.views import FREIGHT_TYPES, MILESTONES
from waybill.operators import joins
from waybill.plans import attach, bookings, changes, cohorts, exposure, invoicing, milestones, otp
from waybill.sources import calendar

KINDS = {"fcl": ("fcl", False), "lcl": ("lcl", False), "air": (None, True)}
DAY = dt.datetime(2020, 3, 1, 12)


def _shipments(spark, cases):
    """Rows with every milestone NULL except those given, as days after DAY."""
    names = list(MILESTONES)
    rows = []
    for i, case in enumerate(cases):
        volume, air = KINDS[case["kind"]]
        stamps = [
            DAY + dt.timedelta(days=case["at"][n]) if n in case["at"] else None for n in names
        ]
        quoted = case.get("quoted", (5, 10))
        rows.append(
            (
                i,
                case.get("volume", volume),
                case.get("air", air),
                case["freight"],
                case["freight"],
                *(quoted if case["kind"] != "air" or case.get("ocean_quote") else (None, None)),
                *(quoted if case["kind"] == "air" else (None, None)),
                *stamps,
            )
        )
    columns = ", ".join(f"{n} timestamp_ntz" for n in names)
    schema = (
        "shipment_id int, volume_kind string, is_air boolean, ocean_freight_type string, "
        "air_freight_type string, ocean_transit_min int, ocean_transit_max int, "
        f"air_transit_min int, air_transit_max int, {columns}"
    )
    return spark.createDataFrame(rows, schema)


# (kind, freight type): start, completion fallback order, local completion, end.
AIR_END = [
    "actual_deconsolidation_ready_for_pickup_at",
    "actual_deconsolidation_departed_at",
    "actual_arrival_port_departed_at",
]
FULL = ["actual_in_full_delivered_at", "scheduled_in_full_delivered_at"]
EXPECTED = {
    ("fcl", "Port to Door"): ("actual_departure_port_arrived_at", FULL),
    ("fcl", "Port to Port"): (
        "actual_departure_port_arrived_at",
        ["actual_final_port_departed_at", "scheduled_final_port_departed_at"],
    ),
    ("fcl", "Door to Port"): (
        "actual_cargo_ready_date_local",
        ["actual_final_port_departed_at", "scheduled_final_port_departed_at"],
    ),
    ("fcl", "Door to Door"): ("actual_cargo_ready_date_local", FULL),
    ("lcl", "Port to Door"): ("actual_consolidation_arrived_at", FULL),
    ("lcl", "Port to Port"): (
        "actual_consolidation_arrived_at",
        ["actual_deconsolidation_departed_at", "scheduled_deconsolidation_departed_at"],
    ),
    ("lcl", "Door to Port"): (
        "actual_cargo_ready_date_local",
        ["scheduled_deconsolidation_departed_at"],
    ),
    ("lcl", "Door to Door"): ("actual_cargo_ready_date_local", FULL),
    ("air", "Port to Door"): ("actual_consolidation_arrived_at", FULL),
    ("air", "Port to Port"): (
        "actual_consolidation_arrived_at",
        [*AIR_END, "scheduled_deconsolidation_departed_at", "scheduled_arrival_port_departed_at"],
    ),
    ("air", "Door to Port"): (
        "actual_cargo_ready_date_local",
        [*AIR_END, "scheduled_deconsolidation_departed_at", "scheduled_arrival_port_departed_at"],
    ),
    ("air", "Door to Door"): ("actual_cargo_ready_date_local", FULL),
}


def test_every_rule_cell_takes_start_and_completion_in_order(spark):
    cases, want = [], []
    for (kind, freight), (start, ends) in EXPECTED.items():
        for skip in range(len(ends)):
            at = {n: 7 + j for j, n in enumerate(ends) if j >= skip}
            cases.append({"kind": kind, "freight": freight, "at": {start: 0, **at}})
            want.append((DAY, (DAY + dt.timedelta(days=7 + skip)).date()))
    got = otp.responsible_trip(_shipments(spark, cases)).orderBy("shipment_id").collect()
    assert [(r.start_at, r.completion_date) for r in got] == want


def test_air_start_falls_back_to_departure_port(spark):
    cases = [{"kind": "air", "freight": "Port to Door", "at": {"actual_departure_port_arrived_at": 3}}]
    got = otp.responsible_trip(_shipments(spark, cases)).collect()[0]
    assert got.start_at == DAY + dt.timedelta(days=3)
    assert got.transit_days is None


def test_no_rule_gives_nothing(spark):
    cases = [
        {"kind": "fcl", "volume": "other", "freight": "Port to Door", "at": dict.fromkeys(MILESTONES, 1)},
        {"kind": "fcl", "freight": None, "at": dict.fromkeys(MILESTONES, 1)},
    ]
    got = otp.otp_status(_shipments(spark, cases), "2020-01-01").collect()
    assert all(r.start_at is None and r.completion_date is None for r in got)
    assert all(r.transit_on_time == "False" and r.milestones_complete == "No" for r in got)


def test_on_time_branches(spark):
    start, end = "actual_cargo_ready_date_local", "actual_in_full_delivered_at"
    local = "actual_in_full_delivered_at_local"

    def case(kind="fcl", done=None, local_done=None, **more):
        at = {start: 0}
        if done is not None:
            at |= {end: done, local: done if local_done is None else local_done}
        return {"kind": kind, "freight": "Door to Door", "at": at, **more}

    cases = [
        (case(done=5), "True"),  # first day of the window
        (case(done=10), "True"),  # last day
        (case(done=4), "False"),  # early, window already open by as_of
        (case(done=11), "False"),
        (case(done=7, local_done=11), "False"),  # judged by the local completion
        (case(), "False"),  # unfinished and due
        (case(quoted=(40, 50)), "Not Eligible"),  # unfinished, not yet due
        (case(done=4, quoted=(40, 50)), "Not Eligible"),  # finished early, not yet due
        (case(quoted=(None, 50)), "False"),
        (case(kind="air", done=6), "True"),
        (case(kind="air", done=11), "False"),
        (case(kind="air", quoted=(40, 50)), "False"),  # no ocean quote
        (case(kind="air", quoted=(40, 50), ocean_quote=True), "Not Eligible"),
        (case(kind="air", done=6, quoted=(None, 9)), "False"),
    ]
    got = (
        otp.otp_status(_shipments(spark, [c for c, _ in cases]), "2020-03-20")
        .orderBy("shipment_id")
        .collect()
    )
    assert [r.transit_on_time for r in got] == [w for _, w in cases]


PORTS = {f"actual_{p}_at_local" for p in ("first_port_arrived", "first_port_departed", "final_port_arrived", "final_port_departed")}
ORIGIN = {"actual_cargo_ready_date_local", "actual_origin_departed_at_local"}
CONSOL = {
    f"actual_{p}_at_local"
    for p in ("consolidation_arrived", "consolidation_departed", "deconsolidation_arrived", "deconsolidation_departed")
}


@pytest.mark.parametrize("kind", ["fcl", "lcl", "air"])
@pytest.mark.parametrize("freight", FREIGHT_TYPES)
def test_required_milestones(spark, kind, freight):
    needed = set(PORTS)
    if kind != "fcl":
        needed |= CONSOL
    if freight.startswith("Door") or (kind, freight) == ("fcl", "Port to Door"):
        needed |= ORIGIN
    delivered = freight.endswith("Door")
    full, first = "actual_in_full_delivered_at_local", "actual_first_delivered_at_local"
    every = needed | ({full} if delivered else set())
    cases = [(every, "Yes")] + [(every - {n}, "No") for n in sorted(every)]
    if delivered:
        cases.append((needed | {first}, "No" if kind == "fcl" else "Yes"))
    frame = _shipments(
        spark, [{"kind": kind, "freight": freight, "at": dict.fromkeys(at, 1)} for at, _ in cases]
    )
    got = otp.otp_status(frame, "2020-03-20").orderBy("shipment_id").collect()
    assert [r.milestones_complete for r in got] == [w for _, w in cases]


def test_report_window_is_two_quarters(spark, frame):
    days = ["2019-12-31", "2020-01-01", "2020-06-30", "2020-07-01"]
    df = frame("id int, day string", list(enumerate(days))).select(
        "id",
        F.col("day").cast("date").alias("completion_date"),
        F.lit("x").alias("freight_type"),
        F.lit("final Destination").alias("transportation_status"),
        F.lit(True).alias("wants_freight"),
        F.lit("EUROPE").alias("destination_region"),
    )
    got = otp.otp_report(df.union(df), "2020-05-05", "Europe", "Final Destination", ["id"])
    assert sorted(r.id for r in got.collect()) == [1, 2]


def _stamp(text):
    return None if text is None else dt.datetime.fromisoformat(text)


INVOICE = (
    "invoice_id int, shipment_id int, invoice_type string, invoiceable_type string, issued_at timestamp_ntz, "
    "voided_at timestamp_ntz, deleted_at timestamp_ntz, issuing_entity string, currency string, revenue double"
)


def test_invoice_rules(frame, rows):
    def invoice(i, shipment, issued, kind="Invoice", on="Shipment", voided=None, deleted=None):
        stamps = (_stamp(issued), _stamp(voided), _stamp(deleted))
        return (i, shipment, kind, on, *stamps, "e", "USD", 1.0)

    inv = frame(
        INVOICE,
        [
            invoice(1, 1, "2020-06-04T00:00:00"),  # exactly due
            invoice(2, 1, "2020-06-05T12:00:00"),
            invoice(3, 1, "2020-06-02T00:00:00", kind="Bill"),
            invoice(4, 1, "2020-06-02T00:00:00", on="Quote"),
            invoice(5, 1, "2020-06-02T00:00:00", voided="2020-06-03T00:00:00"),
            invoice(6, 1, "2020-06-02T00:00:00", deleted="2020-06-03T00:00:00"),
            invoice(7, 2, "2020-06-02T00:00:00"),  # never delivered
            invoice(8, 3, "2020-06-02T00:00:00"),  # unknown shipment
            invoice(9, 1, "2020-05-31T00:00:00"),  # before the start
            invoice(10, 1, None),
        ],
    )
    timeline = frame(
        "shipment_id int, delivered_at timestamp_ntz",
        [(1, _stamp("2020-06-01T00:00:00")), (2, None), (3, _stamp("2020-06-01T00:00:00"))],
    )
    known = frame("shipment_id int", [(1,), (1,), (2,)])
    got = invoicing.invoice_timeliness(inv, timeline, known, "2020-06-01")
    once = [(1, True, Decimal("0.0000")), (2, False, Decimal("1.5000"))]
    assert rows(got, "invoice_id", "on_time", "days_to_share") == sorted(once * 2, key=repr)
    single = invoicing.invoice_timeliness(inv, timeline, known, "2020-06-01", exists_only=True)
    assert rows(single, "invoice_id", "on_time", "days_to_share") == once
    details = invoicing.invoice_details(inv, "2020-06-02", "2020-06-04")
    assert sorted(r.invoice_id for r in details.collect()) == [7, 8]


def test_weekly_bookings_count_a_shipment_once(frame, rows):
    df = frame(
        "shipment int, at date, id int, level string",
        [
            (1, dt.date(2024, 1, 7), 1, "plus"),
            (1, dt.date(2024, 1, 20), 2, "plus"),
            (2, dt.date(2024, 1, 8), 3, "premium"),
            (3, dt.date(2024, 1, 8), 4, "basic"),
            (4, None, 5, "plus"),
        ],
    )
    got = bookings.weekly_bookings(df, "shipment", ["at", "id"], "at", "level", ["plus", "premium"])
    assert rows(got) == [(dt.date(2024, 1, 8), "plus", 1), (dt.date(2024, 1, 8), "premium", 1)]


def test_collateral_equals_brute_force(spark, frame):
    start, end = dt.date(2019, 1, 1), dt.date(2019, 1, 10)
    spans = [
        ("2018-12-20T00:00:00", "2019-01-02T00:00:00", 10.0),
        ("2019-01-03T00:00:00", "2019-01-03T00:00:00", 1.25),
        ("2019-01-04T00:00:01", "2019-01-06T23:00:00", 2.5),  # starts after midnight of the 4th
        ("2019-01-08T00:00:00", "2019-01-05T00:00:00", 99.0),  # reversed
        ("2019-01-09T00:00:00", None, 99.0),
        (None, "2019-01-09T00:00:00", 99.0),
        ("2019-01-09T00:00:00", "2019-03-01T00:00:00", 4.0),
        ("2019-02-09T00:00:00", "2019-03-01T00:00:00", 99.0),
        ("2019-01-02T00:00:00", "2019-01-04T00:00:00", None),
    ]
    df = frame(
        "start_at timestamp_ntz, end_at timestamp_ntz, imputed_value double",
        [(_stamp(a), _stamp(b), c) for a, b, c in spans],
    )
    got = exposure.daily_collateral(df, calendar(spark, str(start), str(end)), str(start), str(end))
    want = {}
    for i in range(10):
        day = start + dt.timedelta(days=i)
        midnight = dt.datetime.combine(day, dt.time())
        want[day] = sum(
            c for a, b, c in spans if a and b and c and _stamp(a) <= midnight <= _stamp(b)
        )
    assert {r.date_day: float(r.in_transit_value) for r in got.collect()} == want


def test_outstanding_by_status(spark, frame):
    start, end = "2019-01-01", "2019-01-05"
    d = dt.date
    repay = frame(
        "origination_id int, outlaid_on date, is_collected boolean, is_charged_off boolean, "
        "repaid_on date, charged_off_on date, is_deleted boolean, principal decimal(18,2)",
        [
            (1, d(2019, 1, 2), True, False, d(2019, 1, 4), None, False, Decimal("1.00")),
            (2, d(2018, 1, 1), False, True, None, d(2019, 1, 3), False, Decimal("10.00")),
            (3, d(2019, 1, 3), False, False, None, None, False, Decimal("100.00")),
            (4, d(2019, 1, 1), True, True, d(2019, 1, 2), d(2019, 1, 4), False, Decimal("1000.00")),
            (5, d(2019, 1, 1), False, False, None, None, True, Decimal("7.00")),
            (6, d(2019, 1, 1), False, False, None, None, False, Decimal("7.00")),
            (7, d(2019, 1, 1), True, False, None, None, False, Decimal("7.00")),
        ],
    )
    live = frame(
        "origination_id int, is_live_origination boolean",
        [(i, i != 6) for i in range(1, 8)],
    )
    days = calendar(spark, start, end)
    got = exposure.daily_outstanding(repay, live, days, start, end)
    values = [float(r.outstanding_principal) for r in got.orderBy("date_day").collect()]
    assert values == [1010.0, 1011.0, 1101.0, 100.0, 100.0]


def test_attach_rate_without_base_is_null(frame, rows):
    df = frame("k string, at date, a int, b int", [("x", dt.date(2020, 1, 5), 1, 0), ("x", dt.date(2020, 2, 5), 1, 2)])
    got = attach.attach_rate(df, ["k"], "at", F.col("a"), F.col("b"))
    assert rows(got, "month", "attach_rate") == [(1, None), (2, 0.5)]


def test_update_speed_bounds_are_strict(frame, rows):
    df = frame(
        "source string, created_by string, lead_hours double",
        [
            ("feed", "u", -10.0),
            ("feed", "u", 0.0),
            ("feed", "u", -336.0),
            ("human", "u", -20.0),
            ("human", "nobody", -20.0),  # no known type
            ("other", "u", -20.0),
            (None, "u", -20.0),
            ("feed", None, -20.0),
        ],
    )
    users = frame("created_by string, user_type string", [("u", "individual")])
    got = milestones.update_speed(df, users, ["feed"], ["human"])
    assert rows(got) == [("bot", 1, -10.0), ("individual", 1, -20.0)]


def test_update_speed_query_counts_every_update(spark, frame, rows, tmp_path):
    events = [
        (1, 0, "click", 110.0),
        (2, 0, "purchase", 120.0),  # not an event type that another report calls actual
        (3, 1, "view", 130.0),  # its order has another priority
        (900, 2, "view", 140.0),  # no order
    ]
    updates = frame("event_id long, user_id long, event_type string, value double", events)
    updates.withColumn("ts", F.lit(DAY).cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    orders = [(2, "1-URGENT"), (4, "3-MEDIUM"), (6, "5-LOW")]
    frame("o_orderkey long, o_orderpriority string", orders).write.parquet(f"{tmp_path}/orders.parquet")
    got = catalog.queries()["update_speed_by_user_type"](spark, str(tmp_path))
    assert rows(got) == [("bot", 1, -10.0), ("group", 1, -40.0), ("individual", 1, -20.0), ("shared", 1, -30.0)]


def test_milestone_extract_upper_bound(frame):
    df = frame(
        "update_id int, leg_id int, shipment_id int, event_type string, created_at timestamp_ntz",
        [
            (1, 1, 1, "arrival", _stamp("2020-07-31T00:00:00")),
            (2, 1, 1, "arrival", _stamp("2020-07-31T10:00:00")),
            (3, 9, 9, "departure", _stamp("2020-07-01T00:00:00")),
            (4, 1, 1, "other", _stamp("2020-07-02T00:00:00")),
        ],
    )
    legs, ships = frame("leg_id int, leg_mode string", [(1, "x")]), frame("shipment_id int, mode string", [(1, "y")])
    args = (df, legs, ships, "2020-07-01", "2020-07-31", ["arrival", "departure"])
    assert sorted(r.update_id for r in milestones.milestone_updates(*args).collect()) == [1, 3]
    half = milestones.milestone_updates(*args, half_open=True)
    assert [(r.update_id, r.mode, r.leg_mode) for r in half.collect()] == [(3, None, None)]


def test_change_trail(frame, rows):
    df = frame(
        "audit_id int, leg_id int, changed_at timestamp_ntz, new_value string",
        [
            (1, 1, _stamp("2020-01-01T10:00:00"), "n/a"),
            (3, 1, _stamp("2020-01-01T11:30:00"), '"2020-02-01"'),
            (2, 1, _stamp("2020-01-01T11:30:00"), "2020-02-11"),
            (4, 1, _stamp("2020-03-01T00:00:00"), "2020-02-06"),
            (5, 2, _stamp("2020-03-01T00:00:00"), "2020-02-06"),
        ],
    )
    got = changes.change_trail(df)
    assert rows(got, "audit_id", "change_order", "days_from_prev", "days_from_first") == [
        (1, 1, None, None),
        (2, 2, None, 0),
        (3, 2, -10, -10),
        (4, 4, 5, -5),
        (5, 1, None, None),
    ]


def test_lifetimes(frame, rows):
    df = frame(
        "c int, at date",
        [(1, dt.date(2015, 1, 1)), (1, dt.date(2015, 1, 20)), (2, dt.date(2015, 7, 1))],
    )
    got = cohorts.client_lifetimes(df, "c", "at", "2015-08-01", quiet_weeks=26)
    assert rows(got, "c", "lifetime_weeks", "has_died", "churn_date") == [
        (1, 2, True, dt.date(2015, 1, 20)),
        (2, 0, False, None),
    ]


def test_transit_interval_by_freight_type(spark):
    day = lambda n: dt.datetime(2020, 1, n)
    schema = "id int, freight_type string, " + ", ".join(
        f"{c} timestamp_ntz"
        for c in (
            "actual_origin_departed_at",
            "actual_departure_port_departed_at",
            "actual_arrival_port_arrived_at",
            "actual_first_delivered_at",
            "actual_in_full_delivered_at",
        )
    )
    stops = (day(1), day(2), day(3), day(4), day(5))
    data = [(i, kind, *stops) for i, kind in enumerate(exposure.TRANSIT)]
    data += [
        (4, "Door to Door", day(1), None, day(3), day(4), None),
        (5, "Door to Door", day(1), None, day(3), None, None),
        (6, "Port to Port", day(1), day(2), None, day(4), day(5)),
        (7, None, *stops),
        (8, "Port to Door", day(1), None, day(3), day(4), day(5)),
    ]
    got = {r.id: (r.start_at, r.end_at) for r in exposure.transit_interval(spark.createDataFrame(data, schema)).collect()}
    assert got == {
        0: (day(1), day(5)),
        1: (day(1), day(3)),
        2: (day(2), day(5)),
        3: (day(2), day(3)),
        4: (day(1), day(4)),
        5: (day(1), day(3)),
        6: (day(2), day(4)),
        7: (None, day(4)),
        8: (None, day(5)),
    }


def test_financed_shipments(frame, rows):
    df = frame(
        "shipment_id int, invoice_type string, invoiceable_type string, deleted_at date, voided_at date, capital_amount double",
        [
            (1, "Invoice", "Shipment", None, None, 5.0),
            (1, "Invoice", "Shipment", None, None, 7.0),
            (2, "Invoice", "Shipment", None, None, 0.0),
            (3, "Bill", "Shipment", None, None, 5.0),
            (4, "Invoice", "Booking", None, None, 5.0),
            (5, "Invoice", "Shipment", dt.date(2020, 1, 1), None, 5.0),
            (6, "Invoice", "Shipment", None, dt.date(2020, 1, 1), 5.0),
            (7, "Invoice", "Shipment", None, None, None),
        ],
    )
    assert rows(exposure.financed(df)) == [(1,)]


def test_changes_per_key(frame):
    df = frame("leg_id string, audit_id int", [("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), ("d", 6), ("e", 7), (None, 8)])
    got = [tuple(r) for r in changes.changes_per_key(df).collect()]
    assert got == [(1, 3, 0.6), (2, 2, 0.4)]
    assert [tuple(r) for r in changes.changes_per_key(df, top=1).collect()] == [(1, 3, 0.6)]


def _quotes(frame):
    """Quotes of shipments and clients that miss now and then, times of which one comes twice, and one client's hot pair."""
    rows = [
        (1, 7, 1, DAY.date(), True, 5.0, "Air"),
        (2, 7, 1, None, False, 3.0, "Ocean"),
        (3, 7, None, DAY.date(), False, 9.0, "Air"),
        (4, None, 1, DAY.date() + dt.timedelta(days=1), False, 2.0, "Air"),
        (5, None, None, None, True, 1.0, "Ocean"),
        (None, 8, 2, None, False, 4.0, "Ocean"),
    ]
    schema = "quote_id long, shipment_id long, client_id long, quote_accepted_date date, is_live boolean, cost double, mode string"
    quotes = frame(schema, rows).selectExpr(
        "*",
        "if(quote_id = 1, 'LCL', 'Not LCL') AS lcl",
        "quote_id = 2 AS acceptor_is_staff",
        "cost AS chargeable_weight",
        "cost AS teu",
        "cost AS volume",
        "int(cost) AS transit_time_max",
        "int(cost) AS transit_time_min",
        "timestamp_ntz'2020-01-01 00:00:00' AS requested_at",
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, int(cost)) AS submitted_at",
    )
    items = frame("quote_id long, template_id int", [(1, 1), (1, 2), (2, 2), (None, 1)])
    times = frame("quote_id long, origin_days int, destination_days int, port_to_port_days int", [(1, 4, 1, 1), (1, 6, 1, 1), (3, 8, 2, None), (None, 99, 99, 99)])
    booked = frame("shipment_id long, client_id long", [(7, 1), (7, 1), (None, None), (7, None)])
    return quotes, items, times, booked, ("autobook", "staff", "client")


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_quote_enrichment_of_missing_keys_and_repeated_times(frame, rows, monkeypatch, hot):
    monkeypatch.setattr(joins.spread_join, "__defaults__", (*joins.spread_join.__defaults__[:-1], hot))
    got = otp.quote_enrichment(*_quotes(frame))
    day, next_day = DAY.date(), DAY.date() + dt.timedelta(days=1)
    columns = ["quote_id", "shipment_id", "client_id", "origin_days", "is_air_quote", "acceptor", "mode_blended", "won_cost", "lost_cost", "total_cost"]
    columns += ["quoted_origin_days", "quoted_port_to_port_days", "hours_to_share", "first_air_acceptance", "last_acceptance"]
    of_7 = (9.0, 3.0, 12.0, 8, 1, 3)
    assert rows(got, *columns) == sorted(
        [
            (1, 7, 1, 4, True, "autobook", "Air", *of_7, day, next_day),
            (1, 7, 1, 6, True, "autobook", "Air", *of_7, day, next_day),
            (2, 7, 1, None, False, "autobook", "Ocean FCL", *of_7, day, next_day),
            (3, 7, None, 8, None, "client", "Air", *of_7, None, None),
            (4, None, 1, None, None, "client", "Air", None, None, 0.0, None, None, None, day, next_day),
            (5, None, None, None, None, "client", "Ocean FCL", None, None, 0.0, None, None, None, None, None),
            (None, 8, 2, None, None, "client", "Ocean FCL", None, 4.0, 4.0, None, None, 4, None, None),
        ],
        key=repr,
    )


def test_quote_enrichment_joins_quotes_to_group_values_once(frame):
    plan = otp.quote_enrichment(*_quotes(frame))._jdf.queryExecution().analyzed()
    found, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            sides = [node.left().output().mkString(" "), node.right().output().mkString(" ")]
            found.append(all("_salt" in s for s in sides) and any("quote_id" in s for s in sides))
    assert sum(found) == 1
