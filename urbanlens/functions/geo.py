"""Geospatial column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanlens import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = C.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km; exactly 0 for identical points."""
    la1, lo1, la2, lo2 = (_c(v).cast("double") for v in (lat1, lon1, lat2, lon2))
    dlat = F.radians(la2 - la1)
    dlon = F.radians(lo2 - lo1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(dlon / 2), 2)
    d = F.lit(2 * radius_km) * F.asin(F.sqrt(a))
    return F.when((la1 == la2) & (lo1 == lo2), F.lit(0.0)).otherwise(d)
