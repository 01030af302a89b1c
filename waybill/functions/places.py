"""Expressions about places and goods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the Earth in kilometres.
EARTH_RADIUS_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance between two points given in degrees."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2.0)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2.0)
    )
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(1.0) - h, F.lit(0.0))))


def density(weight: Column | str, volume: Column | str) -> Column:
    return F.try_divide(_col(weight), _col(volume))
