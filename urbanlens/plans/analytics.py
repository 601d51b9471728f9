"""Analytic queries R01-R42 over the marts.

Every function takes an object exposing the marts (``Warehouse``) plus
parameters and returns a lazy DataFrame. A fact is grouped by the key of a
dimension first (partial aggregates, map-side), and only the groups are joined
with the dimension, so no join sees a fact and no broadcast hint is needed: the
planner picks the join from the sizes it knows. Ties in every top-k are broken by name, so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.functions import columns as X

DateRange = tuple[int | Column, int | Column]
ALL_DATES: DateRange = (19000101, 29991231)


def _in_range(col: str, rng: DateRange) -> Column:
    return F.col(col).between(rng[0], rng[1])


def _by(fact: DataFrame, keys: Sequence[str | Column], measure: str | None = None) -> DataFrame:
    """The fact grouped by the key of a lookup, before the lookup: row count ``_n`` and the
    measure's sum ``_s`` and count ``_c``, from which every later total follows. The join
    then sees one row per key instead of the fact."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if measure:
        aggs += [F.sum(measure).alias("_s"), F.count(measure).alias("_c")]
    return fact.groupBy(*keys).agg(*aggs)


def _mean(dp: int | None = None, scale: float = 1.0) -> Column:
    m = F.sum("_s") / F.sum("_c") / scale if scale != 1.0 else F.sum("_s") / F.sum("_c")
    return m if dp is None else F.round(m, dp)


def _avg_minutes(col: str, dp: int = 1) -> Column:
    return F.round(F.avg(col) / 60.0, dp)


# --- benchmark analyses ----------------------------------------------------------

def daily_mobility_summary(wh) -> DataFrame:
    """One row per day with activity, calendar attributes joined."""
    d = wh.dim_date.select("date_key", "full_date", "day_of_week", "is_weekend", "is_holiday")
    m = wh.fct_daily_mobility
    return (m.join(d, "date_key").select(
        "full_date", "day_of_week", "is_weekend", "is_holiday", "total_delay_incidents",
        "total_delay_minutes", "avg_delay_minutes", "total_gap_minutes", "subway_delay_incidents",
        "bus_delay_incidents", "streetcar_delay_incidents", "total_bike_trips",
        "total_bike_duration_seconds", "avg_bike_duration_seconds", "member_trips", "casual_trips")
        .orderBy("full_date"))


def top_delay_stations(wh, n: int = 10) -> DataFrame:
    """Top subway stations by delay minutes, with per-day rate (J06, A05 count distinct,
    T02 top-10 with a name tiebreak, Q18)."""
    f = _by(wh.fct_transit_delays.filter(F.col("transit_mode") == "subway"), ["station_key", "date_key"], "delay_minutes")
    s = wh.dim_station.select("station_key", "station_name", "station_type")
    return (f.join(s, "station_key").groupBy("station_name", "station_type").agg(
        F.sum("_n").alias("delay_count"),
        F.sum("_s").alias("total_delay_minutes"),
        _mean(2).alias("avg_delay_minutes"),
        F.round(F.sum("_s") * 1.0 / F.count_distinct("date_key"), 2).alias("delay_minutes_per_day"))
        .orderBy(F.desc("total_delay_minutes"), "station_name").limit(n))


def bike_weather_correlation(wh) -> DataFrame:
    """Days, mean and total trips per temperature bucket (J08, A08 group by expression, Q14)."""
    m = wh.fct_daily_mobility.filter(F.col("total_bike_trips").isNotNull())
    w = wh.dim_weather.select("date_key", "mean_temp_c")
    return (m.join(w, "date_key")
            .groupBy(X.temperature_bucket("mean_temp_c").alias("temp_bucket")).agg(
                F.count(F.lit(1)).alias("days_in_bucket"),
                F.round(F.avg("total_bike_trips"), 0).alias("avg_daily_trips"),
                F.round(F.sum("total_bike_trips"), 0).alias("total_trips"))
            .orderBy("temp_bucket"))


def cross_modal_analysis(wh) -> DataFrame:
    """Bike trips on low / medium / high delay days."""
    m = wh.fct_daily_mobility.filter(F.col("total_bike_trips").isNotNull()
                                     & F.col("total_delay_incidents").isNotNull())
    return (m.groupBy(X.delay_day_bucket("total_delay_minutes").alias("ttc_delay_category")).agg(
        F.count(F.lit(1)).alias("days"),
        F.round(F.avg("total_bike_trips"), 0).alias("avg_bike_trips"),
        F.round(F.avg("total_delay_incidents"), 1).alias("avg_delay_incidents"))
        .orderBy("ttc_delay_category"))


def monthly_trends(wh) -> DataFrame:
    """Monthly activity with seasonal context."""
    d = wh.dim_date.select("date_key", "year", "month_num", "month_name")
    return (wh.fct_daily_mobility.join(d, "date_key")
            .groupBy("year", "month_num", "month_name").agg(
                F.count(F.lit(1)).alias("active_days"),
                F.sum("total_delay_incidents").alias("total_delay_incidents"),
                F.round(F.avg("total_delay_minutes"), 1).alias("avg_daily_delay_minutes"),
                F.sum("total_bike_trips").alias("total_bike_trips"),
                F.round(F.avg("total_bike_trips"), 0).alias("avg_daily_bike_trips"),
                F.sum("member_trips").alias("total_member_trips"),
                F.sum("casual_trips").alias("total_casual_trips"))
            .orderBy("year", "month_num"))


# --- dashboard heroes and builders ------------------------------------------------

def hero_total_delay_hours(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """coalesce(sum, 0) / 60 over a date-key range (A06, P23 BETWEEN)."""
    f = wh.fct_transit_delays.filter(_in_range("date_key", rng))
    return f.agg((F.coalesce(F.sum("delay_minutes"), F.lit(0)) / 60).alias("total_delay_hours"))


def hero_total_bike_trips(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """Fact count; ``hero_daily_bike_trips`` is the same number from the daily fact."""
    return wh.fct_bike_trips.filter(_in_range("date_key", rng)).agg(
        F.count(F.lit(1)).alias("total_bike_trips"))


def hero_daily_bike_trips(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    return wh.fct_daily_mobility.filter(_in_range("date_key", rng)).agg(
        F.coalesce(F.sum("total_bike_trips"), F.lit(0)).alias("total_bike_trips"))


def hero_worst_station(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """Worst station (J06, T03 top-1)."""
    f = wh.fct_transit_delays.filter((F.col("transit_mode") == "subway") & _in_range("date_key", rng))
    s = wh.dim_station.select("station_key", "station_name")
    return (_by(f, ["station_key"], "delay_minutes").join(s, "station_key").groupBy("station_name")
            .agg(F.sum("_s").alias("total_delay_minutes"))
            .orderBy(F.desc("total_delay_minutes"), "station_name").limit(1))


def hero_data_freshness(wh) -> DataFrame:
    """Latest calendar date that has mobility data (J10 semi join, A07 max)."""
    d = wh.dim_date.join(wh.fct_daily_mobility.select("date_key"), "date_key", "left_semi")
    return d.agg(F.max("full_date").alias("latest_date"))


def monthly_aggregation(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """R10."""
    d = wh.dim_date.select("date_key", "year", "month_num")
    return (wh.fct_daily_mobility.filter(_in_range("date_key", rng)).join(d, "date_key")
            .groupBy("year", F.col("month_num").alias("month")).agg(
                F.sum("total_delay_incidents").alias("total_delay_incidents"),
                F.sum("total_bike_trips").alias("total_bike_trips"))
            .orderBy("year", "month"))


def mode_comparison(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """R11."""
    return (wh.fct_transit_delays.filter(_in_range("date_key", rng)).groupBy("transit_mode").agg(
        F.count(F.lit(1)).alias("delay_count"), F.sum("delay_minutes").alias("total_delay_minutes")))


def ttc_station_delays(wh, modes: Sequence[str] = C.TRANSIT_MODES, rng: DateRange = ALL_DATES) -> DataFrame:
    """Mapped stations with coordinates."""
    f = wh.fct_transit_delays.filter(_in_range("date_key", rng)
                                     & X.one_of("transit_mode", modes, C.TRANSIT_MODES)
                                     & F.col("station_key").isNotNull())
    s = wh.dim_station.select("station_key", "station_name", "latitude", "longitude")
    return (_by(f, ["station_key"], "delay_minutes").join(s, "station_key").groupBy("station_name", "latitude", "longitude").agg(
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_delay_minutes"))
        .orderBy(F.desc("total_delay_minutes"), "station_name"))


def ttc_delay_causes(wh, modes: Sequence[str] = C.TRANSIT_MODES, rng: DateRange = ALL_DATES) -> DataFrame:
    """Category -> description hierarchy (J09 inner join on the code key)."""
    f = wh.fct_transit_delays.filter(_in_range("date_key", rng)
                                     & X.one_of("transit_mode", modes, C.TRANSIT_MODES)
                                     & F.col("delay_code_key").isNotNull())
    c = wh.dim_delay_codes.select("delay_code_key", "delay_category", "delay_description")
    return (_by(f, ["delay_code_key"], "delay_minutes").join(c, "delay_code_key").groupBy("delay_category", "delay_description").agg(
        F.sum("_n").alias("incident_count"), F.sum("_s").alias("total_delay_minutes")))


def ttc_hourly_pattern(wh, modes: Sequence[str] = C.TRANSIT_MODES, rng: DateRange = ALL_DATES) -> DataFrame:
    """Hour x weekday matrix."""
    f = wh.fct_transit_delays.filter(_in_range("date_key", rng)
                                     & X.one_of("transit_mode", modes, C.TRANSIT_MODES))
    d = wh.dim_date.select("date_key", "day_of_week", "day_of_week_num")
    return (_by(f, ["date_key", F.hour("incident_timestamp").alias("hour_of_day")]).join(d, "date_key")
            .groupBy("hour_of_day", "day_of_week", "day_of_week_num")
            .agg(F.sum("_n").alias("delay_count"))
            .orderBy("day_of_week_num", "hour_of_day"))


def ttc_monthly_trend(wh, modes: Sequence[str] = C.TRANSIT_MODES, rng: DateRange = ALL_DATES) -> DataFrame:
    """R15."""
    f = wh.fct_transit_delays.filter(_in_range("date_key", rng)
                                     & X.one_of("transit_mode", modes, C.TRANSIT_MODES))
    d = wh.dim_date.select("date_key", "year", "month_num", "month_name")
    return (_by(f, ["date_key"], "delay_minutes").join(d, "date_key").groupBy("year", "month_num", "month_name").agg(
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_delay_minutes"))
        .orderBy("year", "month_num"))


def bike_station_activity(wh, user_types: Sequence[str] = C.USER_TYPES, rng: DateRange = ALL_DATES) -> DataFrame:
    """R16."""
    f = wh.fct_bike_trips.filter(_in_range("date_key", rng)
                                 & X.one_of("user_type", user_types, C.USER_TYPES))
    s = wh.dim_station.select(F.col("station_key").alias("start_station_key"), "station_name",
                              "latitude", "longitude", "neighborhood")
    return (_by(f, ["start_station_key"]).join(s, "start_station_key")
            .groupBy("station_name", "latitude", "longitude", "neighborhood")
            .agg(F.sum("_n").alias("trip_count"))
            .orderBy(F.desc("trip_count"), "station_name"))


def bike_yearly_summary(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """R17."""
    d = wh.dim_date.select("date_key", "year")
    m = wh.fct_daily_mobility.filter(_in_range("date_key", rng) & F.col("total_bike_trips").isNotNull())
    return (m.join(d, "date_key").groupBy("year").agg(
        F.sum("total_bike_trips").alias("total_trips"), F.sum("member_trips").alias("member_trips"),
        F.sum("casual_trips").alias("casual_trips"),
        F.sum("total_bike_duration_seconds").alias("total_duration_seconds")).orderBy("year"))


def bike_monthly_seasonality(wh, rng: DateRange = ALL_DATES) -> DataFrame:
    """R18."""
    d = wh.dim_date.select("date_key", "year", "month_num", "month_name")
    m = wh.fct_daily_mobility.filter(_in_range("date_key", rng) & F.col("total_bike_trips").isNotNull())
    return (m.join(d, "date_key").groupBy("year", "month_num", "month_name").agg(
        F.sum("total_bike_trips").alias("total_trips"), F.sum("member_trips").alias("member_trips"),
        F.sum("casual_trips").alias("casual_trips")).orderBy("year", "month_num"))


def weather_daily_metrics(wh) -> DataFrame:
    """Per-day weather and mobility rows (J08, P26 OR of not-nulls, P20 casts)."""
    w = wh.dim_weather
    m = wh.fct_daily_mobility
    j = m.join(w, "date_key").filter(
        F.col("mean_temp_c").isNotNull()
        & (F.col("total_bike_trips").isNotNull() | F.col("total_delay_incidents").isNotNull()))
    return j.select(
        "date_key", "weather_condition", X.as_double("mean_temp_c").alias("mean_temp_c"),
        X.as_double("total_precip_mm", 0).alias("total_precip_mm"),
        X.as_double("total_rain_mm").alias("total_rain_mm"),
        X.as_double("total_snow_cm").alias("total_snow_cm"),
        "total_bike_trips", "total_delay_incidents", "total_delay_minutes", "member_trips",
        "casual_trips").orderBy("date_key")


def _stats_with_mode(base: DataFrame, label: str, measure: str, aggs) -> DataFrame:
    """One pass: group by ``label`` (map-side partial), then a global aggregate that
    rebuilds the row-level statistics from the group sums and picks the most
    frequent non-NULL label (W05; ties: smallest label)."""
    g = base.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_s"),
                                F.count(measure).alias("_c"))
    lab = F.col(label)
    top = F.min_by(lab, F.when(lab.isNotNull(), F.struct(-F.col("_n"), lab))).alias(f"top_{label}")
    return g.agg(*aggs, top)


def station_delay_metrics(wh, station_key: str, rng: DateRange = ALL_DATES) -> DataFrame:
    """One station's delay statistics and its most frequent category (P25 key + range,
    J09 left join, A14/W05 mode; the scalar subquery J14 becomes one global aggregate)."""
    f = wh.fct_transit_delays.filter((F.col("station_key") == station_key) & _in_range("date_key", rng))
    c = wh.dim_delay_codes.select("delay_code_key", "delay_category")
    base = f.join(c, "delay_code_key", "left").select("delay_minutes", "delay_category")
    return _stats_with_mode(base, "delay_category", "delay_minutes", [
        F.coalesce(F.sum("_n"), F.lit(0)).alias("delay_count"),
        F.coalesce(F.sum("_s"), F.lit(0)).alias("total_delay_minutes"),
        F.round(F.sum("_s") / F.sum("_c"), 1).alias("avg_delay_minutes")])


def station_trip_metrics(wh, station_key: str, rng: DateRange = ALL_DATES) -> DataFrame:
    """One station's trips, mean duration in minutes, most frequent user type."""
    base = wh.fct_bike_trips.filter((F.col("start_station_key") == station_key)
                                    & _in_range("date_key", rng)).select("duration_seconds", "user_type")
    return _stats_with_mode(base, "user_type", "duration_seconds", [
        F.coalesce(F.sum("_n"), F.lit(0)).alias("trip_count"),
        F.round(F.sum("_s") / F.sum("_c") / 60.0, 1).alias("avg_duration_minutes")])


def station_delay_timeline(wh, station_key: str, rng: DateRange = ALL_DATES) -> DataFrame:
    """R22."""
    f = wh.fct_transit_delays.filter((F.col("station_key") == station_key) & _in_range("date_key", rng))
    d = wh.dim_date.select("date_key", "year", "month_num", "month_name")
    return (_by(f, ["date_key"], "delay_minutes").join(d, "date_key").groupBy("year", "month_num", "month_name").agg(
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_delay_minutes"))
        .orderBy("year", "month_num"))


def station_trip_timeline(wh, station_key: str, rng: DateRange = ALL_DATES) -> DataFrame:
    """R23."""
    f = wh.fct_bike_trips.filter((F.col("start_station_key") == station_key) & _in_range("date_key", rng))
    d = wh.dim_date.select("date_key", "year", "month_num", "month_name")
    return (_by(f, ["date_key"], "duration_seconds").join(d, "date_key").groupBy("year", "month_num", "month_name").agg(
        F.sum("_n").alias("trip_count"), _mean(1, 60.0).alias("avg_duration_minutes"))
        .orderBy("year", "month_num"))


# --- discovery queries --------------------------------------------------------------

def worst_stations(wh, n: int = 10) -> DataFrame:
    """R24."""
    f = wh.fct_transit_delays.filter(F.col("transit_mode") == "subway")
    s = wh.dim_station.select("station_key", "station_name")
    return (_by(f, ["station_key"], "delay_minutes").join(s, "station_key").groupBy("station_name").agg(
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_delay_minutes"),
        _mean(1).alias("avg_delay_minutes"))
        .orderBy(F.desc("total_delay_minutes"), "station_name").limit(n))


def category_share(wh) -> DataFrame:
    """Categories with percent of all incidents (W04 sum over () on the grouped rows)."""
    c = wh.dim_delay_codes.select("delay_code_key", "delay_category")
    g = (_by(wh.fct_transit_delays, ["delay_code_key"], "delay_minutes").join(c, "delay_code_key").groupBy("delay_category").agg(
        F.sum("_n").alias("incident_count"), F.sum("_s").alias("total_minutes")))
    return (g.withColumn("pct_of_total", F.round(
        100.0 * F.col("incident_count") / F.sum("incident_count").over(Window.partitionBy()), 1))
        .orderBy(F.desc("incident_count"), "delay_category"))


def _by_date_attr(fact: DataFrame, wh, keys: Sequence[str], measure: str, aggs: Sequence[Column], order: Sequence[str]) -> DataFrame:
    d = wh.dim_date.select("date_key", *keys)
    return _by(fact, ["date_key"], measure).join(d, "date_key").groupBy(*keys).agg(*aggs).orderBy(*order)


def delays_by_year(wh) -> DataFrame:
    """R26."""
    return _by_date_attr(wh.fct_transit_delays, wh, ["year"], "delay_minutes", [
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_delay_minutes"),
        _mean(1).alias("avg_delay_minutes")], ["year"])


def delays_by_hour(wh) -> DataFrame:
    """R27."""
    return (wh.fct_transit_delays.groupBy(F.hour("incident_timestamp").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("delay_count"), F.sum("delay_minutes").alias("total_minutes"))
            .orderBy("hour_of_day"))


def delays_by_weekday(wh) -> DataFrame:
    """R28."""
    return _by_date_attr(wh.fct_transit_delays, wh, ["day_of_week", "day_of_week_num"], "delay_minutes", [
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_minutes")],
        ["day_of_week_num"])


def trips_by_year(wh) -> DataFrame:
    """R29."""
    return _by_date_attr(wh.fct_bike_trips, wh, ["year"], "duration_seconds", [
        F.sum("_n").alias("total_trips"), _mean(1, 60.0).alias("avg_duration_minutes")], ["year"])


def user_split_by_year(wh) -> DataFrame:
    """R30."""
    d = wh.dim_date.select("date_key", "year")
    return (_by(wh.fct_bike_trips, ["date_key", "user_type"]).join(d, "date_key").groupBy("year", "user_type")
            .agg(F.sum("_n").alias("trips")).orderBy("year", "user_type"))


def top_start_stations(wh, n: int = 10) -> DataFrame:
    """R31."""
    s = wh.dim_station.select(F.col("station_key").alias("start_station_key"), "station_name")
    return (_by(wh.fct_bike_trips, ["start_station_key"]).join(s, "start_station_key").groupBy("station_name")
            .agg(F.sum("_n").alias("trip_count"))
            .orderBy(F.desc("trip_count"), "station_name").limit(n))


def month_of_year_seasonality(wh) -> DataFrame:
    """R32."""
    return _by_date_attr(wh.fct_bike_trips, wh, ["month_num", "month_name"], "duration_seconds", [
        F.sum("_n").alias("total_trips"), _mean(1, 60.0).alias("avg_duration_minutes")], ["month_num"])


def trips_by_weather(wh) -> DataFrame:
    """R33."""
    w = wh.dim_weather.select("date_key", "weather_condition")
    return (_by(wh.fct_bike_trips, ["date_key"], "duration_seconds").join(w, "date_key").groupBy("weather_condition").agg(
        F.sum("_n").alias("trip_count"), _mean(1, 60.0).alias("avg_duration_minutes"))
        .orderBy(F.desc("trip_count"), "weather_condition"))


def delays_by_weather(wh) -> DataFrame:
    """R34."""
    w = wh.dim_weather.select("date_key", "weather_condition")
    return (_by(wh.fct_transit_delays, ["date_key"], "delay_minutes").join(w, "date_key").groupBy("weather_condition").agg(
        F.sum("_n").alias("delay_count"), F.sum("_s").alias("total_minutes"),
        _mean(1).alias("avg_minutes"))
        .orderBy(F.desc("delay_count"), "weather_condition"))


def correlation_sample(wh, n: int = 100) -> DataFrame:
    """The first ``n`` days of the daily fact with weather (T04; the limit is the feature)."""
    w = wh.dim_weather.select("date_key", "mean_temp_c", "total_precip_mm")
    return (wh.fct_daily_mobility.join(w, "date_key")
            .select("date_key", "total_delay_incidents", "total_delay_minutes", "total_bike_trips",
                    "mean_temp_c", "total_precip_mm")
            .orderBy("date_key").limit(n))


def delay_hero_stats(wh) -> DataFrame:
    """Count, sum, min/max date key."""
    return wh.fct_transit_delays.agg(
        F.count(F.lit(1)).alias("total_delay_incidents"),
        F.sum("delay_minutes").alias("total_delay_minutes"),
        F.round(F.sum("delay_minutes") / 60.0, 0).alias("total_delay_hours"),
        F.min("date_key").alias("min_date"), F.max("date_key").alias("max_date"))


def trip_hero_stats(wh) -> DataFrame:
    """R37."""
    return wh.fct_bike_trips.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.round(F.sum("duration_seconds") / 3600.0, 0).alias("total_trip_hours"),
        _avg_minutes("duration_seconds").alias("avg_trip_minutes"))


def coordinate_completeness(wh) -> DataFrame:
    """R38 / A12."""
    has = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), 1).otherwise(0)
    return wh.dim_station.groupBy("station_type").agg(
        F.count(F.lit(1)).alias("station_count"), F.sum(has).alias("has_coords"),
        F.round(100.0 * F.sum(has) / F.count(F.lit(1)), 1).alias("pct_with_coords"))


def reference_date_bounds(wh) -> DataFrame:
    """Date-picker bounds (A07); ``reference_stations`` / ``reference_delay_codes`` are P30."""
    return wh.dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))


def reference_stations(wh) -> DataFrame:
    return wh.dim_station.select("station_key", "station_id", "station_name", "station_type",
                                 "latitude", "longitude", "neighborhood")


def reference_delay_codes(wh) -> DataFrame:
    return wh.dim_delay_codes.select("delay_code_key", "delay_code", "delay_description", "delay_category")


# --- pickers and small helpers behind the pages -----------------------------------------

def station_picker(wh, station_type: str) -> DataFrame:
    """Stations of one type for a picker, the Unknown placeholder excluded, by name."""
    return (wh.dim_station.filter((F.col("station_type") == station_type)
                                  & (F.col("station_id") != C.UNKNOWN_STATION[1]))
            .select("station_key", "station_name").orderBy("station_name", "station_key"))


def trip_column(user_types: Sequence[str]) -> str:
    """Which daily measure answers a user-type filter."""
    chosen = set(user_types)
    if chosen >= set(C.USER_TYPES):
        return "total_trips"
    return "member_trips" if "Annual Member" in chosen else "casual_trips"


def top_stations_table(wh, n: int = 20) -> DataFrame:
    """The n busiest start stations, projected and renamed for display."""
    return (bike_station_activity(wh).limit(n)
            .select(F.col("station_name").alias("Station"), F.col("neighborhood").alias("Neighbourhood"),
                    F.col("trip_count").alias("Trips")))


def register_views(wh, prefix: str = "") -> None:
    """Expose the marts as temporary views for SQL users."""
    for name in ("dim_date", "dim_station", "dim_weather", "dim_delay_codes",
                 "fct_transit_delays", "fct_bike_trips", "fct_daily_mobility"):
        getattr(wh, name).createOrReplaceTempView(prefix + name)
