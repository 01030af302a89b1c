"""Text and semi-structured expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_money(c: Column | str) -> Column:
    """``'US$1,234.50'`` as 1234.5; text without a number is NULL."""
    digits = F.regexp_replace(_col(c), r"[^0-9.\-]", "")
    return digits.try_cast("double")


def strip_quotes(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit('"'))


def slug(c: Column | str) -> Column:
    """Spaces become underscores."""
    return F.regexp_replace(_col(c), " ", "_")


def same_text(a: Column | str, b: Column | str) -> Column:
    """Equality ignoring case."""
    return F.upper(_col(a)) == F.upper(_col(b))


def truthy(c: Column | str) -> Column:
    """Text flags to boolean: TRUE / True / Yes, FALSE / False / No, other text NULL."""
    t = F.upper(_col(c))
    return F.when(t.isin("TRUE", "YES"), True).when(t.isin("FALSE", "NO"), False)


def change_value(document: Column | str, field: str) -> Column:
    """New value of one field in a change-log document.

    An update stores ``[before, after]``, a creation stores the bare value;
    JSON null, a missing field and a malformed document all give NULL.
    """
    raw = F.get_json_object(_col(document), f"$.{field}")
    pair = raw.startswith("[") & (F.json_array_length(raw) == 2)
    return F.when(pair, F.get_json_object(raw, "$[1]")).otherwise(raw)
