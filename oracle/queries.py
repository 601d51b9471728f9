"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from oracle.duckdb_sql import sql
from urbanlens.plans import params as P

ORACLE: dict[str, str] = {}

_MODELS = {
    "m01_stg_subway": "stg_subway", "m02_stg_bus": "stg_bus", "m03_stg_streetcar": "stg_streetcar",
    "m04_stg_trips": "stg_trips", "m05_stg_weather": "stg_weather",
    "m06_int_delays_unioned": "delays_unioned", "m07_int_delays_enriched": "delays_enriched",
    "m08_int_trips_enriched": "trips_enriched", "m09_int_daily_transit": "daily_transit",
    "m10_int_daily_bike": "daily_bike", "m11_dim_date": "dim_date", "m12_dim_station": "dim_station",
    "m13_dim_weather": "dim_weather", "m14_dim_delay_codes": "dim_delay_codes",
    "m15_fct_transit_delays": "fct_transit_delays", "m16_fct_bike_trips": "fct_bike_trips",
    "m17_fct_daily_mobility": "fct_daily_mobility",
}
for _k, _n in _MODELS.items():
    ORACLE[_k] = sql(f"SELECT * FROM {_n}", _n)

RANGE = "IS NOT NULL"  # the range spans the whole calendar
MODES = "(" + ", ".join(f"'{m}'" for m in sorted(P.MODES)) + ")"
USERS = "(" + ", ".join(f"'{u}'" for u in sorted(P.USER_TYPES)) + ")"


def q(key: str, final: str, *needs: str) -> None:
    ORACLE[key] = sql(final, *needs)


q("r01_daily_summary", """
SELECT d.full_date, d.day_of_week, d.is_weekend, d.is_holiday, m.total_delay_incidents, m.total_delay_minutes,
       m.avg_delay_minutes, m.total_gap_minutes, m.subway_delay_incidents, m.bus_delay_incidents,
       m.streetcar_delay_incidents, m.total_bike_trips, m.total_bike_duration_seconds,
       m.avg_bike_duration_seconds, m.member_trips, m.casual_trips
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key ORDER BY d.full_date""",
  "fct_daily_mobility", "dim_date")
q("r02_top_delay_stations", """
SELECT s.station_name, s.station_type, count(*) AS delay_count, sum(f.delay_minutes)::BIGINT AS total_delay_minutes,
       round(avg(f.delay_minutes), 2) AS avg_delay_minutes,
       round(sum(f.delay_minutes)::DOUBLE / count(DISTINCT f.date_key), 2) AS delay_minutes_per_day
FROM fct_transit_delays f JOIN dim_station s ON f.station_key = s.station_key
WHERE f.transit_mode = 'subway' GROUP BY s.station_name, s.station_type
ORDER BY total_delay_minutes DESC, s.station_name LIMIT 10""", "fct_transit_delays", "dim_station")
q("r03_bike_weather", """
SELECT CASE WHEN w.mean_temp_c < 0 THEN '1. Below Freezing (<0°C)' WHEN w.mean_temp_c < 10 THEN '2. Cold (0-10°C)'
            WHEN w.mean_temp_c < 20 THEN '3. Mild (10-20°C)' ELSE '4. Warm (20°C+)' END AS temp_bucket,
       count(*) AS days_in_bucket, round(avg(m.total_bike_trips), 0) AS avg_daily_trips,
       round(sum(m.total_bike_trips), 0)::BIGINT AS total_trips
FROM fct_daily_mobility m JOIN dim_weather w ON m.date_key = w.date_key
WHERE m.total_bike_trips IS NOT NULL GROUP BY 1 ORDER BY 1""", "fct_daily_mobility", "dim_weather")
q("r04_cross_modal", """
SELECT CASE WHEN m.total_delay_minutes > 500 THEN '3. High Delay (>500 min)'
            WHEN m.total_delay_minutes > 100 THEN '2. Medium Delay (100-500 min)'
            ELSE '1. Low Delay (<100 min)' END AS ttc_delay_category,
       count(*) AS days, round(avg(m.total_bike_trips), 0) AS avg_bike_trips,
       round(avg(m.total_delay_incidents), 1) AS avg_delay_incidents
FROM fct_daily_mobility m WHERE m.total_bike_trips IS NOT NULL AND m.total_delay_incidents IS NOT NULL
GROUP BY 1 ORDER BY 1""", "fct_daily_mobility")
q("r05_monthly_trends", """
SELECT d.year, d.month_num, d.month_name, count(*) AS active_days,
       sum(m.total_delay_incidents)::BIGINT AS total_delay_incidents,
       round(avg(m.total_delay_minutes), 1) AS avg_daily_delay_minutes,
       sum(m.total_bike_trips)::BIGINT AS total_bike_trips, round(avg(m.total_bike_trips), 0) AS avg_daily_bike_trips,
       sum(m.member_trips)::BIGINT AS total_member_trips, sum(m.casual_trips)::BIGINT AS total_casual_trips
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key
GROUP BY d.year, d.month_num, d.month_name ORDER BY d.year, d.month_num""", "fct_daily_mobility", "dim_date")
q("r06_hero_delay_hours", f"""
SELECT coalesce(sum(delay_minutes), 0) / 60 AS total_delay_hours FROM fct_transit_delays
WHERE date_key {RANGE}""", "fct_transit_delays")
q("r07_hero_bike_trips", f"""
SELECT count(*) AS total_bike_trips FROM fct_bike_trips WHERE date_key {RANGE}""", "fct_bike_trips")
q("r07b_hero_daily_bike_trips", f"""
SELECT coalesce(sum(total_bike_trips), 0)::BIGINT AS total_bike_trips FROM fct_daily_mobility
WHERE date_key {RANGE}""", "fct_daily_mobility")
q("r08_hero_worst_station", f"""
SELECT s.station_name, sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_station s ON f.station_key = s.station_key
WHERE f.transit_mode = 'subway' AND f.date_key {RANGE}
GROUP BY s.station_name ORDER BY total_delay_minutes DESC, s.station_name LIMIT 1""",
  "fct_transit_delays", "dim_station")
q("r09_hero_freshness", """
SELECT max(d.full_date) AS latest_date FROM dim_date d
WHERE d.date_key IN (SELECT date_key FROM fct_daily_mobility)""", "dim_date", "fct_daily_mobility")
q("r10_monthly_aggregation", f"""
SELECT d.year, d.month_num AS month, sum(m.total_delay_incidents)::BIGINT AS total_delay_incidents,
       sum(m.total_bike_trips)::BIGINT AS total_bike_trips
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key
WHERE m.date_key {RANGE} GROUP BY d.year, d.month_num ORDER BY d.year, d.month_num""",
  "fct_daily_mobility", "dim_date")
q("r11_mode_comparison", f"""
SELECT transit_mode, count(*) AS delay_count, sum(delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays WHERE date_key {RANGE} GROUP BY transit_mode""", "fct_transit_delays")
q("r12_station_delays", f"""
SELECT s.station_name, s.latitude, s.longitude, count(*) AS delay_count,
       sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_station s ON f.station_key = s.station_key
WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES} AND f.station_key IS NOT NULL
GROUP BY s.station_name, s.latitude, s.longitude ORDER BY total_delay_minutes DESC""",
  "fct_transit_delays", "dim_station")
q("r13_delay_causes", f"""
SELECT c.delay_category, c.delay_description, count(*) AS incident_count,
       sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_delay_codes c ON f.delay_code_key = c.delay_code_key
WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES} AND f.delay_code_key IS NOT NULL
GROUP BY c.delay_category, c.delay_description""", "fct_transit_delays", "dim_delay_codes")
q("r14_hourly_pattern", f"""
SELECT CAST(extract(hour FROM f.incident_timestamp) AS INTEGER) AS hour_of_day, d.day_of_week, d.day_of_week_num,
       count(*) AS delay_count
FROM fct_transit_delays f JOIN dim_date d ON f.date_key = d.date_key
WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES}
GROUP BY 1, d.day_of_week, d.day_of_week_num ORDER BY d.day_of_week_num, hour_of_day""",
  "fct_transit_delays", "dim_date")
q("r15_monthly_delay_trend", f"""
SELECT d.year, d.month_num, d.month_name, count(*) AS delay_count, sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_date d ON f.date_key = d.date_key
WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES}
GROUP BY d.year, d.month_num, d.month_name ORDER BY d.year, d.month_num""", "fct_transit_delays", "dim_date")
q("r16_station_activity", f"""
SELECT s.station_name, s.latitude, s.longitude, s.neighborhood, count(*) AS trip_count
FROM fct_bike_trips f JOIN dim_station s ON f.start_station_key = s.station_key
WHERE f.date_key {RANGE} AND f.user_type IN {USERS}
GROUP BY s.station_name, s.latitude, s.longitude, s.neighborhood ORDER BY trip_count DESC""",
  "fct_bike_trips", "dim_station")
q("r17_yearly_trips", f"""
SELECT d.year, sum(m.total_bike_trips)::BIGINT AS total_trips, sum(m.member_trips)::BIGINT AS member_trips,
       sum(m.casual_trips)::BIGINT AS casual_trips, sum(m.total_bike_duration_seconds)::BIGINT AS total_duration_seconds
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key
WHERE m.date_key {RANGE} AND m.total_bike_trips IS NOT NULL GROUP BY d.year ORDER BY d.year""",
  "fct_daily_mobility", "dim_date")
q("r18_monthly_seasonality", f"""
SELECT d.year, d.month_num, d.month_name, sum(m.total_bike_trips)::BIGINT AS total_trips,
       sum(m.member_trips)::BIGINT AS member_trips, sum(m.casual_trips)::BIGINT AS casual_trips
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key
WHERE m.date_key {RANGE} AND m.total_bike_trips IS NOT NULL
GROUP BY d.year, d.month_num, d.month_name ORDER BY d.year, d.month_num""", "fct_daily_mobility", "dim_date")
q("r19_weather_daily", """
SELECT m.date_key, w.weather_condition, w.mean_temp_c::DOUBLE AS mean_temp_c,
       coalesce(w.total_precip_mm, 0)::DOUBLE AS total_precip_mm, w.total_rain_mm::DOUBLE AS total_rain_mm,
       w.total_snow_cm::DOUBLE AS total_snow_cm, m.total_bike_trips, m.total_delay_incidents,
       m.total_delay_minutes, m.member_trips, m.casual_trips
FROM fct_daily_mobility m JOIN dim_weather w ON m.date_key = w.date_key
WHERE w.mean_temp_c IS NOT NULL AND (m.total_bike_trips IS NOT NULL OR m.total_delay_incidents IS NOT NULL)
ORDER BY m.date_key""", "fct_daily_mobility", "dim_weather")
q("r20_station_delay_metrics", f"""
WITH base AS (
  SELECT f.delay_minutes, c.delay_category FROM fct_transit_delays f
  LEFT JOIN dim_delay_codes c ON f.delay_code_key = c.delay_code_key
  WHERE f.station_key = '{P.SUBWAY_STATION_KEY}' AND f.date_key {RANGE}),
ranked AS (
  SELECT delay_category, row_number() OVER (ORDER BY count(*) DESC, delay_category) AS rn
  FROM base WHERE delay_category IS NOT NULL GROUP BY delay_category)
SELECT count(*) AS delay_count, coalesce(sum(delay_minutes), 0)::BIGINT AS total_delay_minutes,
       round(avg(delay_minutes), 1) AS avg_delay_minutes,
       (SELECT delay_category FROM ranked WHERE rn = 1) AS top_delay_category
FROM base""", "fct_transit_delays", "dim_delay_codes")
q("r21_station_trip_metrics", f"""
WITH base AS (
  SELECT duration_seconds, user_type FROM fct_bike_trips
  WHERE start_station_key = '{P.BIKE_STATION_KEY}' AND date_key {RANGE}),
ranked AS (
  SELECT user_type, row_number() OVER (ORDER BY count(*) DESC, user_type) AS rn
  FROM base WHERE user_type IS NOT NULL GROUP BY user_type)
SELECT count(*) AS trip_count, round(avg(duration_seconds) / 60, 1) AS avg_duration_minutes,
       (SELECT user_type FROM ranked WHERE rn = 1) AS top_user_type
FROM base""", "fct_bike_trips")
q("r22_station_delay_timeline", f"""
SELECT d.year, d.month_num, d.month_name, count(*) AS delay_count, sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_date d ON f.date_key = d.date_key
WHERE f.station_key = '{P.SUBWAY_STATION_KEY}' AND f.date_key {RANGE}
GROUP BY d.year, d.month_num, d.month_name ORDER BY d.year, d.month_num""", "fct_transit_delays", "dim_date")
q("r23_station_trip_timeline", f"""
SELECT d.year, d.month_num, d.month_name, count(*) AS trip_count,
       round(avg(f.duration_seconds) / 60, 1) AS avg_duration_minutes
FROM fct_bike_trips f JOIN dim_date d ON f.date_key = d.date_key
WHERE f.start_station_key = '{P.BIKE_STATION_KEY}' AND f.date_key {RANGE}
GROUP BY d.year, d.month_num, d.month_name ORDER BY d.year, d.month_num""", "fct_bike_trips", "dim_date")
q("r24_worst_stations", """
SELECT s.station_name, count(*) AS delay_count, sum(d.delay_minutes)::BIGINT AS total_delay_minutes,
       round(avg(d.delay_minutes), 1) AS avg_delay_minutes
FROM fct_transit_delays d JOIN dim_station s ON d.station_key = s.station_key
WHERE d.transit_mode = 'subway' GROUP BY s.station_name
ORDER BY total_delay_minutes DESC, s.station_name LIMIT 10""", "fct_transit_delays", "dim_station")
q("r25_category_share", """
SELECT c.delay_category, count(*) AS incident_count, sum(d.delay_minutes)::BIGINT AS total_minutes,
       round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct_of_total
FROM fct_transit_delays d JOIN dim_delay_codes c ON d.delay_code_key = c.delay_code_key
GROUP BY c.delay_category ORDER BY incident_count DESC""", "fct_transit_delays", "dim_delay_codes")
q("r26_delays_by_year", """
SELECT dt.year, count(*) AS delay_count, sum(d.delay_minutes)::BIGINT AS total_delay_minutes,
       round(avg(d.delay_minutes), 1) AS avg_delay_minutes
FROM fct_transit_delays d JOIN dim_date dt ON d.date_key = dt.date_key GROUP BY dt.year ORDER BY dt.year""",
  "fct_transit_delays", "dim_date")
q("r27_delays_by_hour", """
SELECT CAST(extract(hour FROM d.incident_timestamp) AS INTEGER) AS hour_of_day, count(*) AS delay_count,
       sum(d.delay_minutes)::BIGINT AS total_minutes
FROM fct_transit_delays d GROUP BY 1 ORDER BY 1""", "fct_transit_delays")
q("r28_delays_by_weekday", """
SELECT dt.day_of_week, dt.day_of_week_num, count(*) AS delay_count, sum(d.delay_minutes)::BIGINT AS total_minutes
FROM fct_transit_delays d JOIN dim_date dt ON d.date_key = dt.date_key
GROUP BY dt.day_of_week, dt.day_of_week_num ORDER BY dt.day_of_week_num""", "fct_transit_delays", "dim_date")
q("r29_trips_by_year", """
SELECT dt.year, count(*) AS total_trips, round(avg(b.duration_seconds) / 60.0, 1) AS avg_duration_minutes
FROM fct_bike_trips b JOIN dim_date dt ON b.date_key = dt.date_key GROUP BY dt.year ORDER BY dt.year""",
  "fct_bike_trips", "dim_date")
q("r30_user_split_by_year", """
SELECT dt.year, b.user_type, count(*) AS trips FROM fct_bike_trips b JOIN dim_date dt ON b.date_key = dt.date_key
GROUP BY dt.year, b.user_type ORDER BY dt.year, b.user_type""", "fct_bike_trips", "dim_date")
q("r31_top_start_stations", """
SELECT s.station_name, count(*) AS trip_count
FROM fct_bike_trips b JOIN dim_station s ON b.start_station_key = s.station_key
GROUP BY s.station_name ORDER BY trip_count DESC, s.station_name LIMIT 10""", "fct_bike_trips", "dim_station")
q("r32_month_seasonality", """
SELECT dt.month_num, dt.month_name, count(*) AS total_trips, round(avg(b.duration_seconds) / 60.0, 1) AS avg_duration_minutes
FROM fct_bike_trips b JOIN dim_date dt ON b.date_key = dt.date_key
GROUP BY dt.month_num, dt.month_name ORDER BY dt.month_num""", "fct_bike_trips", "dim_date")
q("r33_trips_by_weather", """
SELECT w.weather_condition, count(*) AS trip_count, round(avg(b.duration_seconds) / 60.0, 1) AS avg_duration_minutes
FROM fct_bike_trips b JOIN dim_weather w ON b.date_key = w.date_key
GROUP BY w.weather_condition ORDER BY trip_count DESC""", "fct_bike_trips", "dim_weather")
q("r34_delays_by_weather", """
SELECT w.weather_condition, count(*) AS delay_count, sum(d.delay_minutes)::BIGINT AS total_minutes,
       round(avg(d.delay_minutes), 1) AS avg_minutes
FROM fct_transit_delays d JOIN dim_weather w ON d.date_key = w.date_key
GROUP BY w.weather_condition ORDER BY delay_count DESC""", "fct_transit_delays", "dim_weather")
q("r35_correlation_sample", """
SELECT m.date_key, m.total_delay_incidents, m.total_delay_minutes, m.total_bike_trips, w.mean_temp_c,
       w.total_precip_mm
FROM fct_daily_mobility m JOIN dim_weather w ON m.date_key = w.date_key ORDER BY m.date_key LIMIT 100""",
  "fct_daily_mobility", "dim_weather")
q("r36_delay_hero_stats", """
SELECT count(*) AS total_delay_incidents, sum(delay_minutes)::BIGINT AS total_delay_minutes,
       round(sum(delay_minutes)::DOUBLE / 60.0, 0) AS total_delay_hours, min(date_key) AS min_date, max(date_key) AS max_date
FROM fct_transit_delays""", "fct_transit_delays")
q("r37_trip_hero_stats", """
SELECT count(*) AS total_trips, round(sum(duration_seconds)::DOUBLE / 3600.0, 0) AS total_trip_hours,
       round(avg(duration_seconds) / 60.0, 1) AS avg_trip_minutes FROM fct_bike_trips""", "fct_bike_trips")
q("r38_coordinate_completeness", """
SELECT station_type, count(*) AS station_count,
       sum(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS has_coords,
       round(100.0::DOUBLE * sum(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 1 ELSE 0 END) / count(*), 1)
         AS pct_with_coords
FROM dim_station GROUP BY station_type""", "dim_station")
q("r39_reference_date_bounds", "SELECT min(full_date) AS min_date, max(full_date) AS max_date FROM dim_date",
  "dim_date")
q("r39b_reference_stations", """
SELECT station_key, station_id, station_name, station_type, latitude, longitude, neighborhood FROM dim_station""",
  "dim_station")
q("r39c_reference_delay_codes", """
SELECT delay_code_key, delay_code, delay_description, delay_category FROM dim_delay_codes""", "dim_delay_codes")

# --- quality, calendar, geo, KPIs, joins / windows / reshape ----------------------
from oracle import values as C  # noqa: E402

AS_OF_KEY = P.AS_OF.strftime("%Y%m%d")
_cats = ", ".join(f"'{c}'" for c in C.DELAY_CATEGORIES)
_lines = ", ".join(f"'{c}'" for c in C.SUBWAY_LINES)
lat_min, lat_max, lon_min, lon_max = C.CITY_BBOX

q("d01_unique", """
SELECT trip_sk, count(*) AS n_records FROM fct_bike_trips WHERE trip_sk IS NOT NULL
GROUP BY trip_sk HAVING count(*) > 1""", "fct_bike_trips")
q("d02_not_null", "SELECT delay_sk, transit_mode FROM fct_transit_delays WHERE delay_code_key IS NULL",
  "fct_transit_delays")
q("d03_accepted_values", f"""
SELECT line_code, count(*) AS n_records FROM stg_subway
WHERE line_code IS NOT NULL AND line_code NOT IN ({_lines}) GROUP BY line_code""", "stg_subway")
q("d04_relationships", """
SELECT trip_sk, end_station_key FROM fct_bike_trips f
WHERE end_station_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_station s WHERE s.station_key = f.end_station_key)""",
  "fct_bike_trips", "dim_station")
q("d05_value_between", f"""
SELECT trip_sk, duration_seconds FROM fct_bike_trips
WHERE duration_seconds IS NOT NULL AND NOT (duration_seconds BETWEEN {C.TRIP_SECONDS_RANGE[0]} AND {C.TRIP_SECONDS_RANGE[1]})""",
  "fct_bike_trips")
q("d06_row_count", """
SELECT n_rows FROM (SELECT count(*) AS n_rows FROM fct_daily_mobility) WHERE n_rows < 1 OR n_rows > 20000""",
  "fct_daily_mobility")
q("d07_freshness", f"""
SELECT max_loaded_at, age_days,
       CASE WHEN age_days > {C.FRESHNESS_ERROR_DAYS} THEN 'error' WHEN age_days > {C.FRESHNESS_WARN_DAYS} THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT max(incident_timestamp) AS max_loaded_at,
             CAST(date_diff('day', CAST(max(incident_timestamp) AS DATE), DATE '{P.FRESHNESS_AS_OF}') AS INTEGER) AS age_days
      FROM fct_transit_delays)""", "fct_transit_delays")
_dates = ("(SELECT 'fct_transit_delays' AS table_name, date_key FROM fct_transit_delays WHERE date_key IS NOT NULL "
          "UNION ALL SELECT 'fct_bike_trips', date_key FROM fct_bike_trips WHERE date_key IS NOT NULL)")
_anom = """
SELECT table_name, {t}, value, round(baseline, 4) AS baseline, round(spread, 4) AS spread FROM (
  SELECT table_name, {t}, value,
         avg(value) OVER w AS baseline, stddev_samp(value) OVER w AS spread, count(value) OVER w AS n,
         sum(value) OVER w AS s, sum(value * value) OVER w AS q
  FROM ({src}) WINDOW w AS (PARTITION BY table_name ORDER BY {t} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
WHERE n >= 14 AND n * q > s * s AND pow(n * value - s, 2) * (n - 1) > {k} * {k} * n * (n * q - s * s)"""
q("d08_volume_anomaly", _anom.format(
    t="date_key", k="2.0", src=f"SELECT table_name, date_key, CAST(count(*) AS DOUBLE) AS value FROM {_dates} GROUP BY table_name, date_key"),
  "fct_transit_delays", "fct_bike_trips")
q("d09_freshness_anomaly", _anom.format(
    t="day", k="3.0",
    src="SELECT table_name, day, CAST(gap AS DOUBLE) AS value FROM (SELECT table_name, day, "
        "date_diff('day', lag(day) OVER (PARTITION BY table_name ORDER BY day), day) AS gap FROM (SELECT DISTINCT table_name, "
        f"make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS day FROM {_dates})) WHERE gap IS NOT NULL"),
  "fct_transit_delays", "fct_bike_trips")
q("d07b_load_freshness", " UNION ALL ".join(f"SELECT '{m}' AS source, true AS recent, 'pass' AS status"
                                            for m in ("trips", "weather", "subway", "bus", "streetcar")))
q("d08b_run_history", f"""
WITH m AS (SELECT table_name, CAST(date_key // 100 AS BIGINT) AS run, CAST(count(*) AS DOUBLE) AS rows, CAST(max(date_key % 100) AS DOUBLE) AS last_day
           FROM {_dates} GROUP BY 1, 2),
long AS (SELECT table_name, run, 'rows' AS metric, rows AS value FROM m UNION ALL SELECT table_name, run, 'last_day', last_day FROM m),
w AS (SELECT *, avg(value) OVER w AS baseline, stddev_samp(value) OVER w AS spread, count(value) OVER w AS trained_on FROM long
      WINDOW w AS (PARTITION BY table_name, metric ORDER BY run ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
SELECT table_name, metric, run, value, round(baseline, 4) AS baseline, round(spread, 4) AS spread,
       CASE WHEN trained_on < 14 THEN 'training' WHEN abs(value - baseline) > 1.5 * spread THEN 'anomaly' ELSE 'pass' END AS status
FROM w WHERE run IN (SELECT DISTINCT run FROM m ORDER BY run DESC LIMIT 3)""", "fct_transit_delays", "fct_bike_trips")
q("d10_schema_change", """
SELECT 'user_type' AS column_name, CAST(NULL AS VARCHAR) AS expected_type, 'string' AS actual_type, 'added' AS change,
       count(user_type) AS n_values FROM fct_bike_trips
UNION ALL SELECT 'bike_id', 'string', 'int', 'retyped', count(bike_id) FROM fct_bike_trips
UNION ALL SELECT 'bike_model', 'string', NULL, 'removed', count(bike_id) FROM fct_bike_trips""", "fct_bike_trips")
q("d11_negative_delays", """
SELECT delay_sk, delay_minutes, transit_mode, date_key FROM fct_transit_delays WHERE delay_minutes < 0""",
  "fct_transit_delays")
q("d12_long_trips", """
SELECT trip_sk, duration_seconds, date_key FROM fct_bike_trips WHERE duration_seconds >= 3600""", "fct_bike_trips")
q("d13_future_dates", f"""
SELECT 'fct_transit_delays' AS source_model, date_key FROM fct_transit_delays WHERE date_key > {AS_OF_KEY}
UNION ALL SELECT 'fct_bike_trips', date_key FROM fct_bike_trips WHERE date_key > {AS_OF_KEY}
UNION ALL SELECT 'fct_daily_mobility', date_key FROM fct_daily_mobility WHERE date_key > {AS_OF_KEY}""",
  "fct_transit_delays", "fct_bike_trips", "fct_daily_mobility")
_dod = """
SELECT date_key, daily_activity_count, previous_day_count FROM (
  SELECT date_key, daily_activity_count, lag(daily_activity_count) OVER (ORDER BY date_key) AS previous_day_count
  FROM (SELECT date_key, coalesce(total_delay_incidents, 0) + coalesce(total_bike_trips, 0) AS daily_activity_count
        FROM fct_daily_mobility))
WHERE previous_day_count IS NOT NULL AND previous_day_count > 0
  AND daily_activity_count::DOUBLE / previous_day_count < 0.5"""
q("d14_day_over_day", _dod, "fct_daily_mobility")
q("d15_mapping_coverage", """
SELECT total_rows, mapped_rows, mapped_rows::DOUBLE / nullif(total_rows, 0) AS coverage_ratio FROM (
  SELECT count(*) AS total_rows,
         count(CASE WHEN canonical_station_name <> 'Unknown' THEN canonical_station_name END) AS mapped_rows
  FROM delays_enriched WHERE transit_mode = 'subway')
WHERE mapped_rows::DOUBLE / nullif(total_rows, 0) < 0.99""", "delays_enriched")
q("d16_suite", f"""
SELECT test_name, severity, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM (
  SELECT 'unique_trip_sk' AS test_name, 'error' AS severity,
         (SELECT count(*) FROM (SELECT trip_sk FROM fct_bike_trips WHERE trip_sk IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 'not_null_delay_code_key', 'warn', (SELECT count(*) FROM fct_transit_delays WHERE delay_code_key IS NULL)
  UNION ALL SELECT 'accepted_delay_category', 'error',
         (SELECT count(DISTINCT delay_category) FROM dim_delay_codes WHERE delay_category NOT IN ({_cats}))
  UNION ALL SELECT 'relationship_station_key', 'error',
         (SELECT count(*) FROM fct_transit_delays f WHERE station_key IS NOT NULL
            AND station_key NOT IN (SELECT station_key FROM dim_station))
  UNION ALL SELECT 'delay_minutes_range', 'error',
         (SELECT count(*) FROM fct_transit_delays WHERE delay_minutes IS NOT NULL AND NOT (delay_minutes BETWEEN 0 AND 1440))
  UNION ALL SELECT 'no_negative_delays', 'error', (SELECT count(*) FROM fct_transit_delays WHERE delay_minutes < 0)
  UNION ALL SELECT 'trips_under_a_day', 'warn', (SELECT count(*) FROM fct_bike_trips WHERE duration_seconds >= 86400)
  UNION ALL SELECT 'no_future_dates', 'error',
         (SELECT count(*) FROM fct_transit_delays WHERE date_key > {AS_OF_KEY})
         + (SELECT count(*) FROM fct_bike_trips WHERE date_key > {AS_OF_KEY})
         + (SELECT count(*) FROM fct_daily_mobility WHERE date_key > {AS_OF_KEY})
  UNION ALL SELECT 'day_over_day_stability', 'warn', (SELECT count(*) FROM ({_dod})))""",
  "fct_bike_trips", "fct_transit_delays", "dim_delay_codes", "dim_station", "fct_daily_mobility")
q("d17_seed_structure", """
SELECT 'key_format' AS "check", station_key AS detail FROM station_mapping WHERE NOT regexp_matches(station_key, '^ST_\\d{3}$')
UNION ALL SELECT 'one_name_per_key', station_key FROM station_mapping GROUP BY station_key
  HAVING count(DISTINCT canonical_station_name) > 1
UNION ALL SELECT 'description_words', delay_code FROM delay_codes
  WHERE trim(delay_description) = '' OR len(string_split_regex(trim(delay_description), '\\s+')) > 10
UNION ALL SELECT 'category_domain', delay_code FROM delay_codes WHERE delay_category NOT IN (""" + _cats + ")",
  "station_mapping", "delay_codes")
ORACLE["d16b_failing_rows"] = ("SELECT test_name, severity, failures AS kept_rows FROM (" + ORACLE["d16_suite"]
                                + ") WHERE failures > 0")
q("d17b_seed_coverage", """
SELECT 'station_keys' AS "check", CAST(n AS VARCHAR) AS detail FROM (
  SELECT count(DISTINCT station_key) AS n FROM station_mapping WHERE station_key <> 'ST_000') WHERE n < 75
UNION ALL SELECT 'codes', CAST(n AS VARCHAR) FROM (SELECT count(*) AS n FROM delay_codes) WHERE n < 30
UNION ALL SELECT 'unused_category', c FROM (SELECT unnest([""" + _cats + """]) AS c)
  WHERE c NOT IN (SELECT delay_category FROM delay_codes)""", "station_mapping", "delay_codes")
q("d18_bbox", f"""
SELECT station_key, station_type FROM dim_station
WHERE latitude IS NULL OR longitude IS NULL OR NOT (latitude BETWEEN {lat_min} AND {lat_max})
   OR NOT (longitude BETWEEN {lon_min} AND {lon_max})""", "dim_station")
q("k01_spine", "SELECT full_date FROM dim_date", "dim_date")
q("k02_attributes", """
SELECT date_key, full_date, day_of_week, day_of_week_num, month_num, month_name, quarter, year, is_weekend
FROM dim_date""", "dim_date")
q("k06_holidays", "SELECT holiday_name, holiday_date FROM holidays", "holidays")
q("k07_contiguity", """
SELECT count(*) AS n_rows, min(full_date) AS first_date, max(full_date) AS last_date,
       CAST(date_diff('day', min(full_date), max(full_date)) + 1 AS INTEGER) AS expected_rows,
       sum(CASE WHEN date_diff('day', prev, full_date) > 1 THEN 1 ELSE 0 END)::BIGINT AS gaps,
       sum(CASE WHEN date_diff('day', prev, full_date) = 0 THEN 1 ELSE 0 END)::BIGINT AS duplicates
FROM (SELECT full_date, lag(full_date) OVER (ORDER BY full_date) AS prev FROM dim_date)""", "dim_date")

_hav = """(CASE WHEN {la1} = {la2} AND {lo1} = {lo2} THEN 0.0 ELSE 2 * 6371.0 * asin(sqrt(
  pow(sin(radians({la2} - {la1}) / 2), 2) + cos(radians({la1})) * cos(radians({la2})) * pow(sin(radians({lo2} - {lo1}) / 2), 2))) END)"""
_origin = f"(SELECT CAST(latitude AS DOUBLE) AS la0, CAST(longitude AS DOUBLE) AS lo0 FROM dim_station WHERE station_key = '{P.SUBWAY_STATION_KEY}')"
_dist = _hav.format(la1="o.la0", lo1="o.lo0", la2="CAST(s.latitude AS DOUBLE)", lo2="CAST(s.longitude AS DOUBLE)")
_near = f"""
SELECT CAST(row_number() OVER (ORDER BY d, station_key) AS INTEGER) AS rank, station_key, station_name, station_type, round(d, 2) AS distance_km
FROM (SELECT s.*, {_dist} AS d FROM dim_station s, {_origin} o
      WHERE s.station_key <> '{P.SUBWAY_STATION_KEY}' AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL)
WHERE d IS NOT NULL ORDER BY d, station_key LIMIT {P.NEARBY_N}"""
q("g01_haversine", f"""
SELECT s.station_key, round({_dist}, 4) AS distance_km FROM dim_station s, {_origin} o WHERE s.latitude IS NOT NULL""",
  "dim_station")
q("g02_nearest", f"SELECT rank, station_key, station_name, distance_km FROM ({_near})", "dim_station")
q("g03_bbox", f"""
SELECT station_key FROM dim_station WHERE latitude BETWEEN {lat_min} AND {lat_max} AND longitude BETWEEN {lon_min} AND {lon_max}""",
  "dim_station")
q("g04_centroid", """
SELECT station_type, round(avg(CAST(latitude AS DOUBLE)), 6) AS center_lat, round(avg(CAST(longitude AS DOUBLE)), 6) AS center_lon,
       count(latitude) AS n_points FROM dim_station GROUP BY station_type""", "dim_station")
q("g05_weight", f"""
SELECT station_key, round(CASE WHEN max(distance_km) OVER () > 0
  THEN greatest(60.0, least(80.0, 80.0 - distance_km / max(distance_km) OVER () * 20.0)) ELSE 80.0 END, 4) AS weight
FROM ({_near})""", "dim_station")
q("r41_nearby_table", f"""
SELECT n.rank, n.station_key, n.station_name, n.station_type, n.distance_km,
       coalesce(d.delay_count, 0) AS delay_count, coalesce(t.trip_count, 0) AS trip_count,
       coalesce(CASE n.station_type WHEN 'TTC_SUBWAY' THEN format('{{:,}}', d.delay_count) || ' delays'
                                    WHEN 'BIKE_SHARE' THEN format('{{:,}}', t.trip_count) || ' trips' END, '\u2014') AS activity
FROM ({_near}) n
LEFT JOIN (SELECT station_key, count(*) AS delay_count FROM fct_transit_delays GROUP BY 1) d ON d.station_key = n.station_key
LEFT JOIN (SELECT start_station_key AS station_key, count(*) AS trip_count FROM fct_bike_trips GROUP BY 1) t
  ON t.station_key = n.station_key""", "dim_station", "fct_transit_delays", "fct_bike_trips")
_keys = ", ".join(f"'{k}'" for k in P.COMPARE_SUBWAY_KEYS)
q("r42_compare", f"""
SELECT s.station_name, d.year, d.month_num, count(*) AS delay_count, sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_station s ON f.station_key = s.station_key JOIN dim_date d ON f.date_key = d.date_key
WHERE f.station_key IN ({_keys}) GROUP BY s.station_name, d.year, d.month_num""",
  "fct_transit_delays", "dim_station", "dim_date")

_r12 = ORACLE["r12_station_delays"]
_r13_body = f"""
SELECT c.delay_category, c.delay_description, count(*) AS incident_count, sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_delay_codes c ON f.delay_code_key = c.delay_code_key
WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES} AND f.delay_code_key IS NOT NULL
GROUP BY c.delay_category, c.delay_description"""
_r12_body = f"""
SELECT s.station_name, s.latitude, s.longitude, count(*) AS delay_count, sum(f.delay_minutes)::BIGINT AS total_delay_minutes
FROM fct_transit_delays f JOIN dim_station s ON f.station_key = s.station_key
WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES} AND f.station_key IS NOT NULL
GROUP BY s.station_name, s.latitude, s.longitude"""
_r19_body = """
SELECT m.date_key, w.weather_condition, w.mean_temp_c::DOUBLE AS mean_temp_c, m.total_bike_trips, m.total_delay_incidents
FROM fct_daily_mobility m JOIN dim_weather w ON m.date_key = w.date_key
WHERE w.mean_temp_c IS NOT NULL AND (m.total_bike_trips IS NOT NULL OR m.total_delay_incidents IS NOT NULL)"""
q("r40_kpi_share", f"""
SELECT CASE WHEN sum(total_delay_minutes) > 0 THEN round(sum(CASE WHEN station_name = '{P.SHARE_STATION_NAME}'
  THEN total_delay_minutes ELSE 0 END)::DOUBLE / sum(total_delay_minutes) * 100, 1) ELSE 0.0 END AS station_share_pct
FROM ({_r12_body})""", "fct_transit_delays", "dim_station")
q("a11_category_share", f"""
SELECT CASE WHEN sum(incident_count) > 0 THEN round(sum(CASE WHEN delay_category = '{P.SHARE_CATEGORY}'
  THEN incident_count ELSE 0 END)::DOUBLE / sum(incident_count) * 100, 1) ELSE 0.0 END AS category_share_pct
FROM ({_r13_body})""", "fct_transit_delays", "dim_delay_codes")
q("a13_peak", f"""
WITH h AS (
  SELECT CAST(extract(hour FROM f.incident_timestamp) AS INTEGER) AS hour_of_day, d.day_of_week, d.day_of_week_num,
         count(*) AS delay_count
  FROM fct_transit_delays f JOIN dim_date d ON f.date_key = d.date_key
  WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES} GROUP BY 1, 2, 3),
p AS (SELECT day_of_week, hour_of_day FROM h ORDER BY delay_count DESC, day_of_week_num, hour_of_day LIMIT 1)
SELECT (SELECT sum(delay_count) FROM h)::BIGINT AS total_records,
       CASE WHEN (SELECT sum(delay_count) FROM h) >= {C.PEAK_MIN_RECORDS} THEN left(p.day_of_week, 3) END AS peak_day,
       CASE WHEN (SELECT sum(delay_count) FROM h) >= {C.PEAK_MIN_RECORDS} THEN p.hour_of_day END AS peak_hour
FROM p""", "fct_transit_delays", "dim_date")
q("a13b_busiest_month", f"""
SELECT month_name || ' ' || CAST(year AS VARCHAR) AS busiest_period FROM (
  SELECT d.year, d.month_num, d.month_name, count(*) AS trip_count
  FROM fct_bike_trips f JOIN dim_date d ON f.date_key = d.date_key
  WHERE f.start_station_key = '{P.BIKE_STATION_KEY}' AND f.date_key {RANGE} GROUP BY 1, 2, 3)
ORDER BY trip_count DESC, year, month_num LIMIT 1""", "fct_bike_trips", "dim_date")
q("a15_condition_mean", f"""
SELECT weather_condition, round(avg(total_bike_trips), 0) AS avg_total_bike_trips,
       CAST(CASE weather_condition WHEN 'Clear' THEN 1 WHEN 'Rain' THEN 2 WHEN 'Snow' THEN 3 END AS INTEGER) AS condition_order
FROM ({_r19_body}) GROUP BY weather_condition""", "fct_daily_mobility", "dim_weather")
for _k, _m in (("a16_impact", "total_bike_trips"), ("a16b_delay_impact", "total_delay_incidents")):
    q(_k, f"""
SELECT weather_condition, n_days, round(avg_value, 2) AS avg_value,
       CASE WHEN base > 0 THEN round((avg_value - base) / base * 100, 1) END AS pct_change,
       n_days < {C.LIMITED_SAMPLE_N} AS limited_sample
FROM (SELECT *, max(CASE WHEN weather_condition = 'Clear' THEN avg_value END) OVER () AS base FROM (
  SELECT weather_condition, avg({_m}) AS avg_value, count(*) AS n_days FROM ({_r19_body}) GROUP BY weather_condition))""",
      "fct_daily_mobility", "dim_weather")
q("a17_sweet_spot", f"""
SELECT bin_lo AS peak_low_c, bin_lo + 5 AS peak_high_c FROM (
  SELECT bin_lo, avg(total_bike_trips) AS m FROM (
    SELECT CAST(ceil(mean_temp_c / 5) * 5 - 5 AS INTEGER) AS bin_lo, total_bike_trips FROM ({_r19_body})
    WHERE total_bike_trips IS NOT NULL AND mean_temp_c > -30 AND mean_temp_c <= 40)
  GROUP BY bin_lo) ORDER BY m DESC, bin_lo LIMIT 1""", "fct_daily_mobility", "dim_weather")
q("a18_yoy", f"""
WITH y AS (SELECT d.year, count(*) AS t FROM fct_transit_delays f JOIN dim_date d ON f.date_key = d.date_key
           WHERE f.date_key {RANGE} AND f.transit_mode IN {MODES} GROUP BY d.year)
SELECT min(year) AS first_period, max(year) AS last_period, arg_min(t, year) AS first_total, arg_max(t, year) AS last_total,
       count(*) AS n_periods,
       CASE WHEN count(*) >= 2 AND arg_min(t, year) > 0
            THEN round((arg_max(t, year) - arg_min(t, year))::DOUBLE / arg_min(t, year) * 100, 0) END AS pct_change
FROM y""", "fct_transit_delays", "dim_date")
_r17_body = f"""
SELECT d.year, sum(m.total_bike_trips)::BIGINT AS total_trips, sum(m.member_trips)::BIGINT AS member_trips,
       sum(m.casual_trips)::BIGINT AS casual_trips, sum(m.total_bike_duration_seconds)::BIGINT AS total_duration_seconds
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key
WHERE m.date_key {RANGE} AND m.total_bike_trips IS NOT NULL GROUP BY d.year"""
q("a19_latest_share", f"""
SELECT year, CASE WHEN total_trips > 0 THEN round(casual_trips::DOUBLE / total_trips * 100, 0) END AS share_pct
FROM ({_r17_body}) ORDER BY year DESC LIMIT 1""", "fct_daily_mobility", "dim_date")
q("a20_season_ratio", f"""
SELECT CASE WHEN coalesce(avg(CASE WHEN month_num IN (1, 2) THEN total_trips END), 0) > 0
  THEN round(coalesce(avg(CASE WHEN month_num IN (7, 8) THEN total_trips END), 0)
             / avg(CASE WHEN month_num IN (1, 2) THEN total_trips END), 1) END AS season_ratio
FROM (SELECT d.year, d.month_num, sum(m.total_bike_trips) AS total_trips
      FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key
      WHERE m.date_key {RANGE} AND m.total_bike_trips IS NOT NULL GROUP BY 1, 2)""", "fct_daily_mobility", "dim_date")
q("a21_weighted_mean", f"""
SELECT CASE WHEN sum(total_trips) > 0 THEN round(sum(total_duration_seconds)::DOUBLE / sum(total_trips) / 60, 0) END
  AS avg_trip_minutes FROM ({_r17_body})""", "fct_daily_mobility", "dim_date")
q("a22_pairs", """
SELECT station AS raw_station_name, line, count(*) AS occurrences,
       CAST(min(year(CAST(date AS DATE))) AS INTEGER) AS first_year,
       CAST(max(year(CAST(date AS DATE))) AS INTEGER) AS last_year
FROM raw_subway WHERE station IS NOT NULL AND trim(station) <> '' GROUP BY station, line""", "raw_subway")
q("a22b_rejected_pairs", """
SELECT line, CAST(date AS DATE) AS day, count(*) AS rejected FROM raw_subway
WHERE station IS NULL OR trim(station) = '' GROUP BY ALL""", "raw_subway")
q("a23_primary_line", "SELECT raw_station_name, primary_line, total_occurrences::BIGINT AS total_occurrences FROM primary_line",
  "primary_line")
q("a24_code_counts", "SELECT delay_code, occurrences FROM code_counts", "code_counts")
q("a25_rollup_parent_share", f"""
WITH c AS ({_r13_body}),
r AS (SELECT delay_category, delay_description, sum(incident_count)::BIGINT AS value,
             CAST(grouping(delay_category, delay_description) AS BIGINT) AS level
      FROM c GROUP BY ROLLUP (delay_category, delay_description))
SELECT delay_category, delay_description, level, value,
       round(value::DOUBLE / CASE WHEN level = 0 THEN max(CASE WHEN level = 1 THEN value END) OVER (PARTITION BY delay_category)
                             WHEN level = 1 THEN max(CASE WHEN level = 3 THEN value END) OVER () END * 100, 1) AS pct_of_parent
FROM r""", "fct_transit_delays", "dim_delay_codes")
q("a26_duplicates", """
SELECT date, time, station, line, code, min_delay, count(*) AS n_rows FROM raw_subway
GROUP BY date, time, station, line, code, min_delay HAVING count(*) > 1""", "raw_subway")
q("a27_minmax", f"""
SELECT station_name, round(CASE WHEN max(v) OVER () > min(v) OVER ()
  THEN {C.MAP_RADIUS_MIN} + (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) * {C.MAP_RADIUS_MAX - C.MAP_RADIUS_MIN}
  ELSE {(C.MAP_RADIUS_MIN + C.MAP_RADIUS_MAX) / 2} END, 4) AS radius
FROM (SELECT station_name, total_delay_minutes::DOUBLE AS v FROM ({_r12_body}))""", "fct_transit_delays", "dim_station")
q("w01_dedup", """
SELECT trip_id, trip_duration, start_station_id, start_time, start_station_name, end_station_id, end_time,
       end_station_name, bike_id, user_type FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY trip_duration NULLS FIRST, start_station_id NULLS FIRST,
    start_time NULLS FIRST, start_station_name NULLS FIRST, end_station_id NULLS FIRST, end_time NULLS FIRST,
    end_station_name NULLS FIRST, bike_id NULLS FIRST, user_type NULLS FIRST) AS rn FROM raw_trips) WHERE rn = 1""",
  "raw_trips")
q("u06_unpivot", f"""
SELECT year, 'Annual Member' AS user_type, member_trips AS trip_count FROM ({_r17_body})
UNION ALL SELECT year, 'Casual Member', casual_trips FROM ({_r17_body})""", "fct_daily_mobility", "dim_date")
q("j12_longest_contains", f"""
SELECT name AS raw_station_name, station_key FROM (
  SELECT s.name, l.station_key, row_number() OVER (PARTITION BY s.name ORDER BY length(l.core_name) DESC, l.ordinal, l.core_name) AS r
  FROM (SELECT DISTINCT station AS name FROM raw_subway WHERE station IS NOT NULL) s
  JOIN station_lookup l ON length(l.core_name) >= {C.MIN_SUBSTRING_MATCH} AND contains(s.name, l.core_name)) WHERE r = 1""",
  "raw_subway", "station_lookup")
q("j15_first_match", """
SELECT n.station_name, s.station_key, s.station_type
FROM (SELECT DISTINCT station AS station_name FROM raw_subway WHERE station IS NOT NULL) n
LEFT JOIN (SELECT station_name, station_key, station_type FROM (
             SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY station_key NULLS FIRST) AS r FROM dim_station)
           WHERE r = 1) s ON s.station_name = n.station_name""", "raw_subway", "dim_station")
q("e01_resolve", "SELECT * FROM station_mapping", "station_mapping")
q("e09_classify", "SELECT * FROM delay_codes", "delay_codes")

# --- sources, sinks, contracts, upsert, streaming ------------------------------------
from urbanlens.plans import registry_sources as RS  # noqa: E402
from urbanlens.sources.contracts import CONTRACTS  # noqa: E402

q("s01_read_delimited", "SELECT * FROM raw_subway", "raw_subway")
q("s03_xlsx", "SELECT * FROM raw_weather", "raw_weather")
q("s06_decode", "SELECT * FROM raw_subway", "raw_subway")
q("s07_station_feed", "SELECT * FROM bike_station_ref", "bike_station_ref")
q("s08_zip", "SELECT * FROM raw_trips", "raw_trips")
q("s10_path_year", """
SELECT *, CAST(substr(date, 1, 4) AS INTEGER) AS path_year FROM raw_subway WHERE CAST(substr(date, 1, 4) AS INTEGER) >= 2020""",
  "raw_subway")
q("s14_copy_counts", """
SELECT count(*) AS rows_parsed, sum(CASE WHEN trip_id IS NULL THEN 1 ELSE 0 END)::BIGINT AS empty_key_rows,
       count(*)::BIGINT AS rows_loaded, 0::BIGINT AS errors_seen,
       CAST(NULL AS VARCHAR) AS first_error FROM raw_trips""", "raw_trips")
_stg_trip_cols = ("trip_sk", "trip_duration_seconds", "start_station_id", "start_time", "start_station_name",
                  "end_station_id", "end_time", "end_station_name", "bike_id", "user_type")
_merge_ctes = f"""
WITH tgt AS (SELECT * REPLACE (0 AS trip_duration_seconds) FROM stg_trips
             WHERE start_time < TIMESTAMP '{RS.MERGE_TARGET_BEFORE}'),
src AS (SELECT * FROM stg_trips WHERE start_time >= TIMESTAMP '{RS.MERGE_SOURCE_FROM}'),
src1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY
           {", ".join(c + " NULLS FIRST" for c in _stg_trip_cols)}) AS rn FROM src) WHERE rn = 1)"""
q("s18_merge", _merge_ctes + """
SELECT * FROM tgt WHERE trip_id NOT IN (SELECT trip_id FROM src1) UNION ALL SELECT * FROM src1""", "stg_trips")
q("s18b_merge_stats", _merge_ctes + """
SELECT sum(CASE WHEN trip_id NOT IN (SELECT trip_id FROM tgt) THEN 1 ELSE 0 END)::BIGINT AS inserted,
       sum(CASE WHEN trip_id IN (SELECT trip_id FROM tgt) THEN 1 ELSE 0 END)::BIGINT AS updated
FROM (SELECT DISTINCT trip_id FROM src1)""", "stg_trips")
q("s20_publish", "SELECT * FROM fct_daily_mobility", "fct_daily_mobility")
_raw_col = dict(zip(RS.SUBWAY_FILE_HEADER, ("date", "time", "day", "station", "code", "min_delay", "min_gap",
                                            "bound", "line")))
_surface = ("date", "route", "time", "day", "location", "delay_code", "min_delay", "min_gap", "direction")
_delivered = {
    "subway_delays": ("raw_subway", tuple(_raw_col.values())), "bus_delays": ("raw_bus", _surface),
    "streetcar_delays": ("raw_streetcar", _surface),
    "bike_trips": ("raw_trips", ("trip_id", "trip_duration", "start_station_id", "start_time", "start_station_name", "end_station_id",
                                 "end_time", "end_station_name", "bike_id", "user_type")),
    "weather_daily": ("raw_weather", ("date_time", "mean_temp_c", "total_precip_mm", "snow_on_grnd_cm", "spd_of_max_gust_kmh")),
}
_vparts = []
for _set, (_table, _sources) in _delivered.items():
    for _c, _src in zip(CONTRACTS[_set].columns, _sources):
        _isnull = f"({_src} IS NULL OR upper(trim({_src})) IN ('', 'NULL'))"
        _from = f"'{_set}' AS dataset, '{_c.name}' AS column_name, {_src} AS value FROM {_table}"
        if not _c.nullable:
            _vparts.append(f"SELECT 'null_in_required' AS \"check\", {_from} WHERE {_isnull}")
        if _c.dtype != "STRING":
            _pat = C.TYPE_PATTERNS[_c.dtype].replace("'", "''")
            _vparts.append(f"SELECT 'type_{_c.dtype.lower()}' AS \"check\", {_from} WHERE NOT {_isnull} "
                           f"AND NOT regexp_matches(trim({_src}), '{_pat}')")
q("v04_types", f"""
SELECT dataset, "check", column_name, min(value) AS value, 'error' AS severity, count(*)::BIGINT AS n_rows
FROM ({" UNION ALL ".join(_vparts)}) GROUP BY dataset, "check", column_name""",
  "raw_subway", "raw_bus", "raw_streetcar", "raw_trips", "raw_weather")
q("v10_reconcile", """
SELECT dataset, source_rows, loaded_rows, diff_pct, CASE WHEN diff_pct <= 1.0 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT dataset, source_rows, loaded_rows,
             CASE WHEN source_rows = 0 THEN CASE WHEN loaded_rows = 0 THEN 0.0 ELSE 100.0 END
                  ELSE round(abs(source_rows - loaded_rows)::DOUBLE / source_rows * 100, 4) END AS diff_pct
      FROM (SELECT 'subway' AS dataset, (SELECT count(*) FROM raw_subway) AS source_rows, (SELECT count(*) FROM raw_subway) AS loaded_rows
            UNION ALL SELECT 'bus', (SELECT count(*) FROM raw_bus), (SELECT count(*) FROM raw_bus)
            UNION ALL SELECT 'streetcar', (SELECT count(*) FROM raw_streetcar), (SELECT count(*) FROM raw_streetcar)
            UNION ALL SELECT 'trips', (SELECT count(*) FROM raw_trips), (SELECT count(*) FROM raw_trips)))""",
  "raw_subway", "raw_bus", "raw_streetcar", "raw_trips")
q("st01_incremental_load", """
SELECT trip_id, trip_duration, start_station_id, start_time, start_station_name, end_station_id, end_time,
       end_station_name, bike_id, user_type FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY trip_duration NULLS FIRST, start_station_id NULLS FIRST,
    start_time NULLS FIRST, start_station_name NULLS FIRST, end_station_id NULLS FIRST, end_time NULLS FIRST,
    end_station_name NULLS FIRST, bike_id NULLS FIRST, user_type NULLS FIRST) AS rn FROM (SELECT * REPLACE (CASE WHEN CAST(split_part(trip_id, '-', 1) AS BIGINT) % 5 = 0 THEN '7777' ELSE trip_duration END AS trip_duration)
     FROM raw_trips)) WHERE rn = 1""",
  "raw_trips")
q("s15_drift", """
SELECT date AS "Date", route AS "Route", time AS "Time", day AS "Day", location AS "Location", delay_code AS "Incident",
       min_delay AS "Min Delay", min_gap AS "Min Gap", direction AS "Direction" FROM raw_bus""", "raw_bus")

q("v11_reference_records", """
SELECT 'empty' AS "check", CAST(NULL AS VARCHAR) AS detail FROM (SELECT count(*) AS n FROM bike_station_ref) WHERE n = 0
UNION ALL SELECT 'duplicate_id', CAST(station_id AS VARCHAR) FROM bike_station_ref GROUP BY station_id HAVING count(*) > 1
UNION ALL SELECT 'blank_station_name', CAST(station_id AS VARCHAR) FROM bike_station_ref
  WHERE station_name IS NULL OR trim(station_name) = ''
UNION ALL SELECT 'blank_neighborhood', CAST(station_id AS VARCHAR) FROM bike_station_ref
  WHERE neighborhood IS NULL OR trim(neighborhood) = ''""", "bike_station_ref")
q("v12_mapping_checks", """
SELECT 'duplicate_raw_name' AS "check", raw_station_name AS detail, 'error' AS severity FROM station_mapping
  GROUP BY raw_station_name HAVING count(*) > 1
UNION ALL SELECT 'station_without_variant', station_key, 'warn' FROM subway_registry
  WHERE station_key NOT IN (SELECT station_key FROM station_mapping)
UNION ALL SELECT 'coverage_pct', CAST(round(sum(CASE WHEN m.station_key IS NOT NULL AND m.station_key <> 'ST_000'
    THEN p.total_occurrences ELSE 0 END)::DOUBLE / sum(p.total_occurrences) * 100, 2) AS VARCHAR), 'info'
  FROM primary_line p LEFT JOIN station_mapping m ON m.raw_station_name = p.raw_station_name""",
  "station_mapping", "subway_registry", "primary_line")
q("p28_station_picker", """
SELECT station_key, station_name FROM dim_station WHERE station_type = 'TTC_SUBWAY' AND station_id <> 'ST_000'
ORDER BY station_name, station_key""", "dim_station")
q("t05_top_stations_table", f"""
SELECT s.station_name AS "Station", s.neighborhood AS "Neighbourhood", count(*) AS "Trips"
FROM fct_bike_trips f JOIN dim_station s ON f.start_station_key = s.station_key
WHERE f.date_key BETWEEN 19000101 AND 29991231 AND f.user_type IN {USERS}
GROUP BY s.station_name, s.latitude, s.longitude, s.neighborhood ORDER BY count(*) DESC, s.station_name LIMIT 20""",
  "fct_bike_trips", "dim_station")

_many = " UNION ALL ".join(
    f"""SELECT '{k}' AS origin_key, rank, station_key, distance_km FROM (
  SELECT CAST(row_number() OVER (ORDER BY d, station_key) AS INTEGER) AS rank, station_key, round(d, 2) AS distance_km
  FROM (SELECT s.station_key, {_hav.format(la1="o.la0", lo1="o.lo0", la2="CAST(s.latitude AS DOUBLE)", lo2="CAST(s.longitude AS DOUBLE)")} AS d
        FROM dim_station s, (SELECT CAST(latitude AS DOUBLE) AS la0, CAST(longitude AS DOUBLE) AS lo0 FROM dim_station
                             WHERE station_key = '{k}') o
        WHERE s.station_key <> '{k}' AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL)
  WHERE d IS NOT NULL ORDER BY d, station_key LIMIT 5)""" for k in P.COMPARE_SUBWAY_KEYS)
q("j13_nearest_many", _many, "dim_station")

q("j13b_nearest_all", f"""
SELECT origin_key, rank, station_key, round(d, 2) AS distance_km FROM (
  SELECT o.station_key AS origin_key, s.station_key, CAST(row_number() OVER (PARTITION BY o.station_key ORDER BY d, s.station_key) AS INTEGER) AS rank, d
  FROM (SELECT *, CAST(latitude AS DOUBLE) AS la0, CAST(longitude AS DOUBLE) AS lo0 FROM dim_station) o
  JOIN dim_station s ON s.station_key <> o.station_key,
  LATERAL (SELECT {_hav.format(la1="o.la0", lo1="o.lo0", la2="CAST(s.latitude AS DOUBLE)", lo2="CAST(s.longitude AS DOUBLE)")} AS d)
  WHERE o.latitude IS NOT NULL AND s.latitude IS NOT NULL) WHERE rank <= 3""", "dim_station")

_nparts = []
for _set, (_table, _sources) in _delivered.items():
    for _c, _src in zip(CONTRACTS[_set].columns, _sources):
        _nparts.append(f"SELECT '{_set}' AS dataset, '{_c.name}' AS column_name, {str(_c.nullable).upper()} AS nullable, "
                       f"count(*) FILTER (WHERE {_src} IS NULL OR upper(trim({_src})) IN ('', 'NULL'))::BIGINT "
                       f"AS null_rows FROM {_table}")
q("v05_nulls", f"""
SELECT *, CASE WHEN null_rows > 0 AND NOT nullable THEN 'error' ELSE 'pass' END AS status
FROM ({" UNION ALL ".join(_nparts)})""", "raw_subway", "raw_bus", "raw_streetcar", "raw_trips", "raw_weather")
q("e10_description", "SELECT delay_code, delay_description FROM delay_codes", "delay_codes")
q("e11_neighbourhood", "SELECT station_id, neighborhood FROM bike_station_ref", "bike_station_ref")

# --- deviating headers, manifests, loads, sinks --------------------------------------------
_splits = {"case": "h < '5'", "less": "h >= '5' AND h <= '9'", "more": "h > '9' AND h <= 'c'", "[d] e": "h > 'c'", "void": "false"}
_hparts = []
for _set, (_table, _sources) in _delivered.items():
    _names = [c.name for c in CONTRACTS[_set].columns]
    for _delivery, _check, _name, _severity in (
            ("case", "case_mismatch", _names[1].upper(), "warn"), ("less", "missing_column", _names[-1], "error"),
            ("more", "extra_column", "Remarks", "warn"), ("[d] e", "missing_column", _names[1], "error"),
            ("[d] e", "extra_column", f"{_names[1]}, all", "warn"), ("void", "empty_header", None, "error"),
            *[("void", "missing_column", n, "error") for n in _names]):
        _hparts.append(f"""SELECT '{_set}' AS dataset, '{_delivery}' AS delivery, '{_check}' AS "check", {"NULL" if _name is None else f"'{_name}'"} AS column_name,
  '{_severity}' AS severity, count(*) AS n_rows FROM (SELECT left(md5(coalesce({_sources[0]}, '')), 1) AS h FROM {_table})
  WHERE {_splits[_delivery]}""")
q("v01_header_checks", f"SELECT * FROM ({' UNION ALL '.join(_hparts)}) WHERE n_rows > 0 OR delivery = 'void'",
  "raw_subway", "raw_bus", "raw_streetcar", "raw_trips", "raw_weather")
_failed = "missing_column: " + CONTRACTS["weather_daily"].columns[-1].name
_loads = " UNION ALL ".join(
    f"SELECT '{s}' AS dataset, 'load' AS stage, 'success' AS status, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for s, (t, _) in _delivered.items() if s != "weather_daily")
_loads += f" UNION ALL SELECT 'weather_daily', 'validate', 'failed', 0, '{_failed}'"
q("v14_run_summary", f"""
SELECT * FROM ({_loads}) UNION ALL SELECT 'TOTAL', NULL, '4/5', sum(rows)::BIGINT, NULL FROM ({_loads})""",
  "raw_subway", "raw_bus", "raw_streetcar", "raw_trips", "raw_weather")
q("s20b_independent", " UNION ALL ".join(
    f"SELECT '{s}' AS dataset, count(*) AS n_rows, '{'failed' if s in ('weather_daily', 'bike_trips') else 'success'}' AS second_run FROM {t}"
    for s, (t, _) in _delivered.items()), "raw_subway", "raw_bus", "raw_streetcar", "raw_trips", "raw_weather")
q("s11_catalogue", """
SELECT DISTINCT 'Subway Delay (' || substr(date, 1, 4) || ') data' AS name, 'csv' AS format, CAST(substr(date, 1, 4) AS INTEGER) AS year,
       'subway_delay_' || substr(date, 1, 4) || '_data.csv' AS file_name
FROM raw_subway WHERE CAST(substr(date, 1, 4) AS INTEGER) BETWEEN 2010 AND 2029""", "raw_subway")
_number = "CAST(split_part(trip_id, '-', 1) AS BIGINT)"
_files = f"""SELECT {_number} // 10000 AS file, CAST(sum(length(trip_id) + 1) AS BIGINT) AS size_bytes,
  sha256(string_agg(trip_id, chr(10) ORDER BY trip_id) || chr(10)) AS sha256 FROM raw_trips"""
q("s12_manifest", f"{_files} GROUP BY 1", "raw_trips")
q("s13b_ledger", f"""
SELECT *, 3 AS version FROM ({_files} WHERE {_number} // 10000 % 3 <> 0 GROUP BY 1)""", "raw_trips")
q("s13_changed_files", f"SELECT * FROM raw_trips WHERE {_number} % 5 = 0", "raw_trips")
q("s16_strip_extra", "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS min_gap) FROM raw_subway", "raw_subway")
q("s17_seed", "SELECT * FROM bike_station_ref", "bike_station_ref")
_others = ", ".join(f"{c} NULLS FIRST" for c in _delivered["bike_trips"][1][1:])
q("s19_load_dataset", f"""
WITH src AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY {_others}) AS rn
             FROM raw_trips WHERE {_number} % 5 IN (0, 1)) WHERE rn = 1)
SELECT * REPLACE ('1' AS trip_duration) FROM raw_trips WHERE {_number} % 5 <> 0 AND trip_id NOT IN (SELECT trip_id FROM src)
UNION ALL SELECT * FROM src""", "raw_trips")
q("s19b_load_counts", f"""
WITH src AS (SELECT DISTINCT trip_id FROM raw_trips WHERE {_number} % 5 IN (0, 1)),
tgt AS (SELECT DISTINCT trip_id FROM raw_trips WHERE {_number} % 5 <> 0)
SELECT count(*) FILTER (trip_id NOT IN (SELECT trip_id FROM tgt)) AS inserted,
       count(*) FILTER (trip_id IN (SELECT trip_id FROM tgt)) AS updated FROM src""", "raw_trips")
q("s22_sorted_sink", "SELECT * FROM raw_weather", "raw_weather")
q("p32_lower_columns", "SELECT " + ", ".join(f'{c} AS "{h.lower()}"' for h, c in _raw_col.items()) + " FROM raw_subway", "raw_subway")
q("s21_views", """
SELECT d.year, count(*) AS days, sum(m.total_bike_trips)::BIGINT AS trips, sum(m.total_delay_incidents)::BIGINT AS incidents
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key GROUP BY d.year""", "fct_daily_mobility", "dim_date")
q("u07_user_filter", "SELECT date_key, member_trips AS member, casual_trips AS casual, total_trips AS everyone FROM daily_bike",
  "daily_bike")
q("p31_periods", """
SELECT CAST(d.year AS VARCHAR) || '-' || lpad(CAST(d.month_num AS VARCHAR), 2, '0') AS period, count(*) AS days
FROM fct_daily_mobility m JOIN dim_date d ON m.date_key = d.date_key GROUP BY 1""", "fct_daily_mobility", "dim_date")
