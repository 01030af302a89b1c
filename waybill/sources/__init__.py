from waybill.sources.calendars import calendar, calendar_spanning, quarters
from waybill.sources.files import read_csv, read_series_csv
from waybill.sources.frames import (
    from_rows,
    head_rows,
    lower_names,
    rename_all,
    sample_rows,
    tail_rows,
)
from waybill.sources.tables import TABLES, Tables, register_views, run_sql

__all__ = [
    "TABLES",
    "Tables",
    "calendar",
    "calendar_spanning",
    "from_rows",
    "head_rows",
    "lower_names",
    "quarters",
    "read_csv",
    "read_series_csv",
    "register_views",
    "rename_all",
    "run_sql",
    "sample_rows",
    "tail_rows",
]
