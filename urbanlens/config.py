"""Domain parameters.

Everything that must equal the source system's behaviour for right results is
listed once, here, as plain fixed values. Operators take these as defaults and
accept overrides, so a caller can run the same code on another city's data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: domains -------------------------------------------------
TRANSIT_MODES = ("subway", "bus", "streetcar")
USER_TYPES = ("Annual Member", "Casual Member")
SUBWAY_LINES = ("YU", "BD", "SHP", "SRT")
DELAY_CATEGORIES = (
    "Mechanical", "Passenger", "Security", "Infrastructure", "Operations",
    "Weather", "Signal", "General",
)
STATION_TYPES = ("TTC_SUBWAY", "BIKE_SHARE")
UNKNOWN_STATION = ("Unknown", "ST_000")

# --- fixed values: bounding box (lat_min, lat_max, lon_min, lon_max) --------
CITY_BBOX = (43.58, 43.86, -79.64, -79.10)

# --- fixed values: thresholds ----------------------------------------------
MIN_TRIP_SECONDS = 60
LONG_TRIP_SECONDS = 86400
DELAY_MINUTES_RANGE = (0, 1440)
TRIP_SECONDS_RANGE = (60, 86400)
EARTH_RADIUS_KM = 6371.0
FRESHNESS_WARN_DAYS = 45
FRESHNESS_ERROR_DAYS = 90
DAY_OVER_DAY_MIN_RATIO = 0.5
MAPPING_COVERAGE_MIN = 0.99
RECONCILE_TOLERANCE_PCT = 1.0
MIN_SUBSTRING_MATCH = 4
LIMITED_SAMPLE_N = 30
PEAK_MIN_RECORDS = 100

# --- fixed values: bucket labels (upper bound exclusive, label) -------------
DURATION_BUCKETS = (
    (300, "Under 5 min"),
    (900, "5-15 min"),
    (1800, "15-30 min"),
    (3600, "30-60 min"),
    (None, "Over 60 min"),
)
TEMPERATURE_BUCKETS = (
    (0, "1. Below Freezing (<0°C)"),
    (10, "2. Cold (0-10°C)"),
    (20, "3. Mild (10-20°C)"),
    (None, "4. Warm (20°C+)"),
)
# delay-day buckets: (lower bound exclusive, label), checked high to low
DELAY_DAY_BUCKETS = (
    (500, "3. High Delay (>500 min)"),
    (100, "2. Medium Delay (100-500 min)"),
    (None, "1. Low Delay (<100 min)"),
)
WEATHER_CONDITIONS = ("Clear", "Rain", "Snow")
# histogram bins for temperature (right-closed), edges -30..40 step 5
TEMP_BIN_RANGE = (-30, 40, 5)

# --- fixed values: station-name normalisation, in match order --------------
STATION_SUFFIXES = (
    " STATION TO", " STATION (LEAVING", " STATION (APPROA", " STATION (TO KING",
    " STATION (TOWARDS", " STATION (LEA", " STATIO", " STATION", " STN",
)
FACILITY_SUFFIXES = (
    " YARD", " CARHOUSE", " CAR HOUSE", " GARAGE", " SHOPS", " SHOP", " COMPLEX",
    " DIVISION", " DIVSION", " WYE", " PORTAL", " HOSTLER", " BUILD UP",
    " BUILD-UP", " BUILDUP", " CENTRE TRACK", " CENTER TRACK", " CENTER",
    " CENTRE", " SUBSTATION", " ESB", " EE",
)
LINE_SUFFIXES = (" BD", " YUS", " YU", " SRT", " SHP", " SHEP")

# --- fixed values: delay-code classification --------------------------------
PREFIX_CATEGORY = {
    "MU": "Mechanical", "PU": "Passenger", "SU": "Security", "EU": "Infrastructure",
    "TU": "Operations", "MR": "Mechanical", "PR": "Passenger", "SR": "Security",
    "ER": "Infrastructure", "TR": "Operations", "MF": "Mechanical", "PF": "Passenger",
    "SF": "Security", "EF": "Infrastructure", "TF": "Operations", "MT": "Mechanical",
    "PT": "Passenger", "ST": "Security", "ET": "Infrastructure", "TT": "Operations",
    "NT": "General",
}
PREFIX_LABEL = {
    "MU": "Mechanical", "PU": "Passenger", "SU": "Security", "EU": "Equipment",
    "TU": "Train Operations", "MR": "SRT Mechanical", "PR": "SRT Passenger",
    "SR": "SRT Security", "ER": "SRT Equipment", "TR": "SRT Operations",
    "MF": "Fleet Mechanical", "PF": "Fleet Passenger", "SF": "Fleet Security",
    "EF": "Fleet Equipment", "TF": "Fleet Operations", "MT": "Streetcar Mechanical",
    "PT": "Streetcar Passenger", "ST": "Streetcar Security", "ET": "Streetcar Equipment",
    "TT": "Streetcar Operations", "NT": "Streetcar General",
}
TEXT_CATEGORY = {
    "Cleaning": "Operations", "Cleaning - Disinfection": "Operations",
    "Cleaning - Unsanitary": "Operations", "Collision - TTC": "Operations",
    "Collision - TTC Involved": "Operations", "Diversion": "Operations",
    "Emergency Services": "Security", "General Delay": "General", "Held By": "Operations",
    "Investigation": "Security", "Late": "Operations", "Late Entering Service": "Operations",
    "Late Leaving Garage - Operator": "Operations", "Management": "Operations",
    "Mechanical": "Mechanical", "Operations": "Operations",
    "Operations - Operator": "Operations", "Overhead": "Infrastructure",
    "Rail/Switches": "Infrastructure", "Road Blocked - NON-TTC Collision": "Operations",
    "Securitty": "Security", "Security": "Security", "Utilized Off Route": "Operations",
    "Vision": "Operations",
}
CODE_CATEGORY_OVERRIDES = {"PREL": "Infrastructure", "PTW": "Weather", "PRW": "Weather"}
WEATHER_SUFFIXES = ("WEA", "WA")
SIGNAL_SUFFIXES = ("ATC",)

# --- fixed values: station feed neighbourhoods ------------------------------
NON_NEIGHBOURHOOD_GROUPS = ("E-Charging", "North", "South", "East", "West")
DEFAULT_NEIGHBOURHOOD = "Downtown"
NEIGHBOURHOOD_CORRECTIONS = {"Watefront": "Waterfront"}

# --- fixed values: ingestion -----------------------------------------------
NULL_TOKENS = ("", "NULL", "null")
MIN_PATH_YEAR = 2020
DRIFT_YEAR = 2025
BUS_DRIFT_RENAMES = {"Line": "Route", "Station": "Location", "Code": "Incident", "Bound": "Direction"}
STREETCAR_DRIFT_RENAMES = {"Station": "Location", "Code": "Incident"}
TYPE_PATTERNS = {
    "DATE": r"^\d{4}-\d{2}-\d{2}([T ]00:00:00)?$",
    "TIME": r"^\d{1,2}:\d{2}(:\d{2})?$",
    "INTEGER": r"^-?\d+(\.0)?$",
    "DECIMAL": r"^-?\d+\.?\d*$",
    "TIMESTAMP": r"^\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}$|^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2})?$",
}
RESOURCE_YEAR_PATTERN = r"(20[1-2]\d)"

# --- fixed values: calendar -------------------------------------------------
# Nine statutory holidays: (name, month, rule, arg)
#   fixed: day of month; nth_monday: occurrence; easter: offset in days;
#   monday_on_or_before: day of month
HOLIDAYS = (
    ("New Year's Day", 1, "fixed", 1),
    ("Family Day", 2, "nth_monday", 3),
    ("Good Friday", None, "easter", -2),
    ("Victoria Day", 5, "monday_on_or_before", 24),
    ("Canada Day", 7, "fixed", 1),
    ("Civic Holiday", 8, "nth_monday", 1),
    ("Labour Day", 9, "nth_monday", 1),
    ("Thanksgiving", 10, "nth_monday", 2),
    ("Christmas Day", 12, "fixed", 25),
)

# Surrogate-key rendering: parts joined by '-', NULL rendered as a sentinel.
KEY_DELIMITER = "-"
KEY_NULL_SENTINEL = "_null_"


@dataclass(frozen=True)
class MobilityConfig:
    """Parameters an operator may need; defaults are the fixed values above."""

    modes: tuple[str, ...] = TRANSIT_MODES
    user_types: tuple[str, ...] = USER_TYPES
    bbox: tuple[float, float, float, float] = CITY_BBOX
    min_trip_seconds: int = MIN_TRIP_SECONDS
    trip_time_format: str = "M/d/yyyy H:mm"
    null_tokens: tuple[str, ...] = NULL_TOKENS
    extra: dict = field(default_factory=dict)


DEFAULT = MobilityConfig()

# --- fixed values: map sizing -------------------------------------------------
MAP_RADIUS_MIN = 50
MAP_RADIUS_MAX = 500
MAP_RADIUS_DEFAULT = 100
NEARBY_WEIGHT_RANGE = (60.0, 80.0)
