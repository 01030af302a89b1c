"""Date expressions. All of them work on time-zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def boundary_diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    00:59 to 01:01 crosses one hour boundary, so the result is 1, whereas the
    built-in ``timestampdiff`` counts whole elapsed units and gives 0.
    """
    a, b = _col(start), _col(end)
    days = F.datediff(b.cast("date"), a.cast("date")).cast("long")
    if unit == "day":
        return days
    if unit == "week":
        monday = F.datediff(F.trunc(b.cast("date"), "week"), F.trunc(a.cast("date"), "week"))
        return (monday / 7).cast("long")
    months = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
    if unit == "month":
        return months.cast("long")
    if unit == "quarter":
        return ((F.year(b) - F.year(a)) * 4 + (F.quarter(b) - F.quarter(a))).cast("long")
    if unit == "year":
        return (F.year(b) - F.year(a)).cast("long")
    if unit == "hour":
        return days * 24 + F.hour(b) - F.hour(a)
    if unit == "minute":
        return days * 1440 + (F.hour(b) - F.hour(a)) * 60 + F.minute(b) - F.minute(a)
    if unit == "second":
        return (
            days * 86400
            + (F.hour(b) - F.hour(a)) * 3600
            + (F.minute(b) - F.minute(a)) * 60
            + F.second(b)
            - F.second(a)
        )
    raise ValueError(f"unknown unit {unit!r}")


def monday_bucket(c: Column | str) -> Column:
    """Monday label of a date where Sunday counts as day 0 of the week.

    A Sunday therefore goes to the Monday after it, unlike ``trunc(d, 'week')``.
    """
    d = _col(c).cast("date")
    return F.date_add(d, F.lit(2) - F.dayofweek(d))


def month_end(year: Column | str, month: Column | str) -> Column:
    return F.last_day(F.make_date(_col(year), _col(month), F.lit(1)))


def quarter_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "quarter")


def lenient_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Date by format; text that does not parse becomes NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def lenient_timestamp(c: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")
