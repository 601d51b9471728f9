"""Parameters of the registered dashboard queries (P23 date-key range, P24 closed domains).

The date range is that of the calendar, whatever the data hold, so each query runs
over whole tables; the station parameters pick one subway and one bike station (a
single-station drill-down is the feature of those queries).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from urbanlens import config as C

MODES = C.TRANSIT_MODES
USER_TYPES = C.USER_TYPES
SUBWAY_STATION_ID = "ST_004"
BIKE_STATION_ID = "12"
COMPARE_SUBWAY_IDS = ("ST_002", "ST_003", "ST_004")


def station_key(station_type: str, station_id: str) -> str:
    """The surrogate key the marts give a station (same rendering as ``surrogate_key``)."""
    return hashlib.md5(f"{station_type}{C.KEY_DELIMITER}{station_id}".encode()).hexdigest()


def date_range(wh) -> tuple:
    """First and last date key of the calendar, as scalar subqueries (no job while planning)."""
    days = wh.dim_date
    return (days.agg(F.min("date_key")).scalar(), days.agg(F.max("date_key")).scalar())


SUBWAY_STATION_KEY = station_key("TTC_SUBWAY", SUBWAY_STATION_ID)
BIKE_STATION_KEY = station_key("BIKE_SHARE", BIKE_STATION_ID)
COMPARE_SUBWAY_KEYS = tuple(station_key("TTC_SUBWAY", s) for s in COMPARE_SUBWAY_IDS)

# checks dated "today" take the date as a parameter so results are stable
import datetime as _dt  # noqa: E402

AS_OF = _dt.date(2024, 1, 15)
FRESHNESS_AS_OF = _dt.date(2024, 3, 31)
SHARE_STATION_NAME = "NATION_3"
SHARE_CATEGORY = "Operations"
NEARBY_N = 10
