"""Independent DuckDB SQL for the correctness gate.

Each model is a named CTE with its dependencies; ``sql(final, *needs)`` emits
``WITH`` + the needed CTEs in dependency order + the final statement. The
derivations follow the same written rules as the Spark code, but are written
separately (different formulations where that is natural: CASE chains instead
of regexes, a containment join instead of the substring explosion, and so on),
and the domain's values are the oracle's own copy (``values``), so agreement is
evidence, not tautology.
"""

from __future__ import annotations

from oracle import values as C


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else _q(v) for v in values) + "]"


def _strip_end(expr: str, suffixes) -> str:
    parts = [f"WHEN ends_with({expr}, {_q(s)}) THEN rtrim(left({expr}, length({expr}) - {len(s)}))"
             for s in suffixes]
    return f"(CASE {' '.join(parts)} ELSE {expr} END)"


def _cut_first(expr: str, markers) -> str:
    parts = [f"WHEN strpos({expr}, {_q(m)}) > 0 THEN rtrim(left({expr}, strpos({expr}, {_q(m)}) - 1))"
             for m in markers]
    return f"(CASE {' '.join(parts)} ELSE {expr} END)"


def _map_case(expr: str, mapping: dict) -> str:
    parts = [f"WHEN {expr} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items()]
    return f"(CASE {' '.join(parts)} END)"


def _sk(*parts: str) -> str:
    """Surrogate key: md5 of '-'-joined text parts, NULL rendered as the sentinel."""
    rendered = ", ".join(f"coalesce(CAST({p} AS VARCHAR), {_q(C.KEY_NULL_SENTINEL)})" for p in parts)
    return f"md5(concat_ws({_q(C.KEY_DELIMITER)}, {rendered}))"


def _tenths(x: str) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(20,0)) / 10 AS DECIMAL(10,1)) AS VARCHAR)"


def _micro(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(20,0)) / 1000000 AS DECIMAL(10,6))"


def _safe_int(x: str) -> str:
    return f"TRY_CAST(TRY_CAST(trim({x}) AS DECIMAL(38,0)) AS INTEGER)"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


# --- role frames -----------------------------------------------------------
cte("inc_base", """
  SELECT event_id AS rid, event_id * 2 AS src_id, ts, CAST(user_id % 25 AS INTEGER) AS nat,
         CAST(CAST(floor(value) AS BIGINT) % 90 AS INTEGER) AS delay,
         CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS gap
  FROM events
  UNION ALL
  SELECT o_orderkey, o_orderkey * 2 + 1,
         o_orderdate + to_hours(CAST(o_custkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER)),
         CAST(o_custkey % 25 AS INTEGER), CAST(o_orderkey % 120 AS INTEGER),
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey % 60 AS INTEGER) END
  FROM orders""")
cte("inc_rec", f"""
  SELECT * FROM inc_base
  UNION ALL
  SELECT rid, src_id, ts, nat, delay, coalesce(gap, 0) + 1 FROM inc_base WHERE rid % {C.BED_REDELIVERY_EVERY} = 0""",
    "inc_base")
cte("raw_inc", f"""
  SELECT {_list(('subway', 'bus', 'streetcar'))}[CAST(src_id % 3 AS INTEGER) + 1] AS transit_mode,
         CASE WHEN rid % 11 = 0 THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00' ELSE strftime(ts, '%Y-%m-%d') END AS date,
         strftime(ts, '%H:%M') AS time, dayname(ts) AS day,
         CASE WHEN rid % 16 = 7 THEN 'TRACK LEVEL ' || CAST(rid % 9 AS VARCHAR)
              ELSE {_list(C.BED_STATION_PREFIXES)}[CAST(rid % 16 % 8 AS INTEGER) + 1] || n_name
                   || {_list(C.BED_STATION_SUFFIXES)}[CAST(rid % 16 % 8 AS INTEGER) + 1] END AS station,
         n_name AS location,
         CAST(rid % 40 + 1 AS VARCHAR) AS route,
         CASE WHEN rid % 13 = 0 THEN NULL
              WHEN src_id % 3 <> 0 AND rid % 9 = 4 THEN {_list(C.BED_TEXT_CODES)}[nat % 6 + 1]
              ELSE {_list(C.BED_CODE_PREFIXES)}[nat % 21 + 1] || {_list(C.BED_CODE_SUFFIXES)}[CAST(rid % 6 AS INTEGER) + 1] END AS code,
         CASE WHEN rid % 97 = 0 THEN 'abc' WHEN rid % 7 = 0 THEN CAST(delay AS VARCHAR) || '.0'
              ELSE CAST(delay AS VARCHAR) END AS min_delay,
         CAST(gap AS VARCHAR) AS min_gap,
         {_list(C.BED_BOUNDS)}[CAST(rid % 5 AS INTEGER) + 1] AS bound,
         {_list(C.BED_REGION_LINES)}[n_regionkey + 1] AS line
  FROM inc_rec JOIN nation ON nation.n_nationkey = inc_rec.nat""", "inc_rec")
cte("raw_subway", """
  SELECT date, time, day, station, code, min_delay, min_gap, bound, line FROM raw_inc WHERE transit_mode = 'subway'""",
    "raw_inc")
for _m in ("bus", "streetcar"):
    cte(f"raw_{_m}", f"""
  SELECT date, route, time, day, location, code AS delay_code, min_delay, min_gap, bound AS direction
  FROM raw_inc WHERE transit_mode = '{_m}'""", "raw_inc")

cte("raw_trips", """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trip_id,
         CAST(CAST((l_quantity - 1) * 75 AS INTEGER) AS VARCHAR) AS trip_duration,
         CAST(l_suppkey AS VARCHAR) AS start_station_id,
         CASE WHEN l_orderkey % 101 = 0 THEN strftime(st, '%Y-%m-%d %H:%M') ELSE strftime(st, '%-m/%-d/%Y %-H:%M') END AS start_time,
         'Station ' || CAST(l_suppkey AS VARCHAR) AS start_station_name,
         CAST(l_partkey % 120 AS VARCHAR) AS end_station_id,
         strftime(st + to_seconds(CAST((l_quantity - 1) * 75 AS INTEGER)), '%-m/%-d/%Y %-H:%M') AS end_time,
         'Station ' || CAST(l_partkey % 120 AS VARCHAR) AS end_station_name,
         CAST(l_partkey AS VARCHAR) AS bike_id,
         CASE WHEN l_returnflag = 'N' THEN 'Casual Member' ELSE 'Annual Member' END AS user_type
  FROM (SELECT *, l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER))
                  + to_minutes(CAST(l_orderkey % 60 AS INTEGER)) AS st FROM lineitem)""")

cte("raw_weather", f"""
  SELECT strftime(d, '%Y-%m-%d') AS date_time,
         {_tenths('mt + n % 8 * 10')} AS max_temp_c,
         {_tenths('mt - n % 6 * 10')} AS min_temp_c,
         CASE WHEN day(d) <> 13 THEN {_tenths('mt')} END AS mean_temp_c,
         {_tenths('greatest(180 - mt, 0)')} AS heat_deg_days_c,
         {_tenths('greatest(mt - 180, 0)')} AS cool_deg_days_c,
         CASE WHEN day(d) <> 7 THEN {_tenths('rain')} END AS total_rain_mm,
         CASE WHEN day(d) <> 7 THEN {_tenths('snow')} END AS total_snow_cm,
         CASE WHEN day(d) <> 21 THEN {_tenths('rain + snow')} END AS total_precip_mm,
         {_tenths('snow * 2')} AS snow_on_grnd_cm,
         CASE WHEN n % 3 = 0 THEN '<31' ELSE {_tenths('so % 900')} END AS spd_of_max_gust_kmh,
         CAST((sc % 36) * 10 AS VARCHAR) AS dir_of_max_gust_10s_deg
  FROM (SELECT d, sc, so, n, (sc % 600) - 200 AS mt,
               CASE WHEN so % 7 < 4 THEN 0 ELSE so % 90 END AS rain,
               CASE WHEN month(d) IN (12, 1, 2, 3) THEN (sc % 4) * 15 ELSE 0 END AS snow
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, sum(o_custkey) AS sc, sum(o_orderkey) AS so,
                     count(*) AS n FROM orders GROUP BY 1))""")

lat_min, lat_max, lon_min, lon_max = C.CITY_BBOX
cte("bike_station_ref", f"""
  SELECT * FROM (
    SELECT CAST(s_suppkey AS INTEGER) AS station_id, s_name AS station_name,
           {_micro('CASE WHEN s_suppkey % 23 = 11 THEN 43900000 ELSE 43600000 + (s_suppkey % 25) * 10000 + (s_suppkey % 7) * 1000 END')} AS latitude,
           {_micro('-79600000 + (s_suppkey % 40) * 12000')} AS longitude,
           CASE WHEN s_suppkey % 5 = 0 THEN 'West' WHEN s_suppkey % 5 = 1 THEN 'Downtown' ELSE n_name END AS neighborhood
    FROM supplier JOIN nation ON n_nationkey = s_nationkey)
  WHERE station_id > 0 AND latitude BETWEEN {lat_min} AND {lat_max} AND longitude BETWEEN {lon_min} AND {lon_max}""")

cte("subway_registry", """
  SELECT 'ST_' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS station_key,
         n_name AS canonical_station_name,
         ['YU', 'BD', 'SHP', 'SRT', 'YU'][n_regionkey + 1] AS line_code,
         CAST(n_nationkey AS INTEGER) AS ordinal
  FROM nation""")
cte("subway_coords", f"""
  SELECT n_name AS canonical_station_name, n_regionkey + 1 AS line_number,
         {_micro('43640000 + n_nationkey * 5000')} AS latitude,
         {_micro('-79500000 + n_regionkey * 20000')} AS longitude
  FROM nation WHERE n_nationkey < 24""")

_alias = ", ".join(f"({_q(a)}, {_q(k)}, {1000 + i})" for i, (a, k) in enumerate(C.BED_STATION_ALIASES))
cte("station_lookup", f"""
  SELECT canonical_station_name AS core_name, station_key, line_code, ordinal FROM subway_registry
  UNION ALL SELECT a.core_name, a.station_key, g.line_code, a.ordinal
  FROM (VALUES {_alias}) a(core_name, station_key, ordinal) JOIN subway_registry g ON g.station_key = a.station_key""", "subway_registry")

# --- station-name resolution -------------------------------------------------
_ovr = " UNION ALL ".join(f"SELECT {_q(a)} AS raw_station_name, {_q(b)} AS station_key, {_q(c)} AS line_code"
                          for a, b, c in C.BED_STATION_OVERRIDES)
cte("station_overrides", _ovr)
cte("primary_line", """
  SELECT station AS raw_station_name, line AS primary_line, total_occurrences FROM (
    SELECT station, line, row_number() OVER (PARTITION BY station ORDER BY n DESC, line ASC NULLS LAST) AS r,
           sum(n) OVER (PARTITION BY station) AS total_occurrences
    FROM (SELECT station, line, count(*) AS n FROM raw_subway
          WHERE station IS NOT NULL AND trim(station) <> '' GROUP BY station, line)) WHERE r = 1""",
    "raw_subway")


def _chain(src: str, steps) -> str:
    """Subquery (name, core) applying each step to the previous step's column."""
    q = f"(SELECT name, name AS c0 FROM {src})"
    for i, step in enumerate(steps):
        q = f"(SELECT name, {step(f'c{i}')} AS c{i + 1} FROM {q})"
    return f"(SELECT name, c{len(steps)} AS core FROM {q})"


def _rule_sql(src: str) -> str:
    """Candidates (name, priority, station_key, line_code) for rules 1-5 and 7 over src(name)."""
    lk = "station_lookup"
    station = lambda c: _strip_end(c, C.STATION_SUFFIXES)
    line = lambda c: _strip_end(c, C.LINE_SUFFIXES)
    first = lambda pat: (lambda c: f"nullif(trim(regexp_extract({c}, '{pat}', 1)), '')")
    chains = {
        2: [lambda c: _cut_first(c, C.STATION_SUFFIXES), lambda c: _strip_end(c, C.FACILITY_SUFFIXES), line],
        3: [first("^(.+?)\\s+TO\\s+"), station, line],
        4: [first("^(.+?)\\s+AND\\s+"), line],
        7: [first("^BETWEEN\\s+(.+?)\\s+AND\\s+"), station, line],
    }
    rules = [
        f"SELECT s.name, 1 AS priority, o.station_key, o.line_code FROM {src} s "
        f"JOIN station_overrides o ON o.raw_station_name = s.name",
    ]
    for prio, steps in chains.items():
        rules.append(f"SELECT s.name, {prio}, l.station_key, l.line_code FROM "
                     f"{_chain(src, steps)} s JOIN {lk} l ON l.core_name = s.core")
    rules.append(
        f"SELECT name, 5, station_key, line_code FROM (SELECT s.name, l.station_key, l.line_code, "
        f"row_number() OVER (PARTITION BY s.name ORDER BY length(l.core_name) DESC, l.ordinal, l.core_name) AS r "
        f"FROM {src} s JOIN {lk} l ON length(l.core_name) >= {C.MIN_SUBSTRING_MATCH} "
        f"AND contains(s.name, l.core_name)) WHERE r = 1")
    return " UNION ALL ".join(rules)


def _best_sql(cands: str) -> str:
    return (f"SELECT name, priority, station_key, line_code FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY name ORDER BY priority, station_key) AS r FROM ({cands})) WHERE r = 1")


def _norm_line(x: str) -> str:
    u = f"upper(trim({x}))"
    return (f"(CASE WHEN {u} IN ('YU', 'BD', 'SHP', 'SRT') THEN {u} "
            f"WHEN contains({u}, 'SRT') THEN 'SRT' "
            f"WHEN contains({u}, 'SHP') OR contains({u}, 'SHEP') THEN 'SHP' "
            f"WHEN contains({u}, 'BD') AND NOT contains({u}, 'YU') THEN 'BD' ELSE 'YU' END)")


cte("sm_names", "SELECT raw_station_name AS name, primary_line FROM primary_line", "primary_line")
cte("sm_rest", """
  SELECT name, trim(regexp_extract(name, '^\\(?APPROACH(?:ING)?\\)?\\s*(.+)', 1)) AS rest FROM sm_names
  WHERE trim(regexp_extract(name, '^\\(?APPROACH(?:ING)?\\)?\\s*(.+)', 1)) <> ''""", "sm_names")
cte("sm_rest_best", _best_sql(_rule_sql("(SELECT DISTINCT rest AS name FROM sm_rest)")),
    "sm_rest", "station_lookup", "station_overrides")
cte("sm_best", _best_sql(
    _rule_sql("sm_names") + " UNION ALL SELECT r.name, 6, b.station_key, b.line_code FROM sm_rest r "
    "JOIN sm_rest_best b ON b.name = r.rest"), "sm_names", "sm_rest_best", "station_lookup", "station_overrides")
cte("station_mapping", f"""
  SELECT n.name AS raw_station_name,
         coalesce(g.canonical_station_name, 'Unknown') AS canonical_station_name,
         coalesce(b.station_key, 'ST_000') AS station_key,
         coalesce(b.line_code, {_norm_line('n.primary_line')}) AS line_code,
         coalesce(b.priority, 8) AS rule
  FROM sm_names n LEFT JOIN sm_best b ON b.name = n.name
  LEFT JOIN subway_registry g ON g.station_key = b.station_key""", "sm_names", "sm_best", "subway_registry")

# --- delay codes ---------------------------------------------------------------
_sfx = " UNION ALL ".join(f"SELECT {_q(a)} AS suffix, {_q(b)} AS description" for a, b in C.BED_SUFFIX_DESCRIPTIONS)
cte("suffix_desc", _sfx)
cte("code_counts", """
  SELECT delay_code, sum(n)::BIGINT AS occurrences FROM (
    SELECT trim(code) AS delay_code, count(*) AS n FROM raw_subway GROUP BY 1
    UNION ALL SELECT trim(delay_code), count(*) FROM raw_bus GROUP BY 1
    UNION ALL SELECT trim(delay_code), count(*) FROM raw_streetcar GROUP BY 1)
  WHERE delay_code IS NOT NULL AND delay_code <> '' GROUP BY delay_code""",
    "raw_subway", "raw_bus", "raw_streetcar")
_text = _map_case("c.delay_code", C.TEXT_CATEGORY)
_catovr = _map_case("c.delay_code", C.CODE_CATEGORY_OVERRIDES)
_prefix_cat = _map_case("left(c.delay_code, 2)", C.PREFIX_CATEGORY)
_label = _map_case("left(c.delay_code, 2)", C.PREFIX_LABEL)
_descovr = _map_case("c.delay_code", dict(C.BED_DESCRIPTION_OVERRIDES))
_sfx_of = "substr(c.delay_code, 3)"
cte("delay_codes", f"""
  SELECT c.delay_code,
         coalesce({_descovr},
                  CASE WHEN {_text} IS NOT NULL THEN c.delay_code END,
                  CASE WHEN length(c.delay_code) < 2 THEN c.delay_code
                       WHEN {_sfx_of} = '' THEN coalesce({_label} || ' - General', c.delay_code)
                       ELSE coalesce(ld.description, {_label} || ' - Code ' || {_sfx_of}, c.delay_code) END)
           AS delay_description,
         coalesce({_text}, {_catovr},
                  CASE WHEN length(c.delay_code) >= 2 AND {_sfx_of} IN ('WEA', 'WA') THEN 'Weather'
                       WHEN length(c.delay_code) >= 2 AND {_sfx_of} IN ('ATC') THEN 'Signal' END,
                  CASE WHEN length(c.delay_code) >= 2 THEN {_prefix_cat} END, 'General') AS delay_category
  FROM code_counts c
  LEFT JOIN (SELECT delay_code, description FROM (
               SELECT c2.delay_code, s.description,
                      row_number() OVER (PARTITION BY c2.delay_code ORDER BY length(s.suffix) DESC) AS r
               FROM code_counts c2 JOIN suffix_desc s
                 ON length(c2.delay_code) >= 2 AND starts_with(substr(c2.delay_code, 3), s.suffix))
             WHERE r = 1) ld ON ld.delay_code = c.delay_code""", "code_counts", "suffix_desc")

# --- staging --------------------------------------------------------------------
cte("stg_subway", f"""
  SELECT {_sk('date', 'time', 'station', 'line', 'code', 'min_delay')} AS delay_sk,
         CAST(date AS DATE) AS delay_date, CAST(CAST(time AS TIME) AS VARCHAR) AS delay_time,
         CAST(date AS DATE) + CAST(time AS TIME) AS incident_timestamp,
         day AS day_of_week, station AS raw_station_name, code AS delay_code,
         {_safe_int('min_delay')} AS delay_minutes, {_safe_int('min_gap')} AS gap_minutes,
         bound AS direction, line AS line_code, 'subway' AS transit_mode
  FROM (SELECT *, row_number() OVER (PARTITION BY date, time, station, line, code, min_delay
                                     ORDER BY day ASC NULLS FIRST, min_gap ASC NULLS FIRST, bound ASC NULLS FIRST) AS rn
        FROM raw_subway WHERE {_safe_int('min_delay')} > 0) WHERE rn = 1""", "raw_subway")
for _m in ("bus", "streetcar"):
    cte(f"stg_{_m}", f"""
  SELECT {_sk('date', 'time', 'route', 'direction', 'delay_code', 'min_delay')} AS delay_sk,
         CAST(date AS DATE) AS delay_date, CAST(CAST(time AS TIME) AS VARCHAR) AS delay_time,
         CAST(date AS DATE) + CAST(time AS TIME) AS incident_timestamp,
         day AS day_of_week, route, location, delay_code,
         {_safe_int('min_delay')} AS delay_minutes, {_safe_int('min_gap')} AS gap_minutes,
         direction, '{_m}' AS transit_mode
  FROM (SELECT *, row_number() OVER (PARTITION BY date, time, route, direction, delay_code, min_delay
                                     ORDER BY day ASC NULLS FIRST, location ASC NULLS FIRST, min_gap ASC NULLS FIRST) AS rn
        FROM raw_{_m} WHERE {_safe_int('min_delay')} > 0) WHERE rn = 1""", f"raw_{_m}")
cte("stg_trips", f"""
  SELECT {_sk('trip_id')} AS trip_sk, trip_id,
         {_safe_int('trip_duration')} AS trip_duration_seconds,
         {_safe_int('start_station_id')} AS start_station_id,
         try_strptime(start_time, '%m/%d/%Y %H:%M') AS start_time, start_station_name,
         {_safe_int('end_station_id')} AS end_station_id,
         try_strptime(end_time, '%m/%d/%Y %H:%M') AS end_time, end_station_name,
         {_safe_int('bike_id')} AS bike_id, user_type
  FROM raw_trips
  WHERE {_safe_int('trip_duration')} >= {C.MIN_TRIP_SECONDS}
    AND try_strptime(start_time, '%m/%d/%Y %H:%M') IS NOT NULL""", "raw_trips")
_wcols = ", ".join(f"TRY_CAST(trim({s}) AS DECIMAL(10,1)) AS {d}" for s, d in (
    ("max_temp_c", "max_temp_c"), ("min_temp_c", "min_temp_c"), ("mean_temp_c", "mean_temp_c"),
    ("heat_deg_days_c", "heat_degree_days"), ("cool_deg_days_c", "cool_degree_days"),
    ("total_rain_mm", "total_rain_mm"), ("total_snow_cm", "total_snow_cm"),
    ("total_precip_mm", "total_precip_mm"), ("snow_on_grnd_cm", "snow_on_ground_cm"),
    ("spd_of_max_gust_kmh", "max_wind_gust_kmh")))
cte("stg_weather", f"""
  SELECT {_sk('date_time')} AS weather_sk, CAST(date_time AS DATE) AS weather_date, {_wcols},
         {_safe_int('dir_of_max_gust_10s_deg')} AS max_wind_gust_dir_deg
  FROM raw_weather""", "raw_weather")

# --- intermediate -------------------------------------------------------------------
_UN = ("delay_sk, delay_date, delay_time, incident_timestamp, day_of_week, transit_mode, line_code, "
       "route, raw_station_name, location, delay_code, delay_minutes, gap_minutes, direction")
cte("delays_unioned", f"""
  SELECT {_UN} FROM (SELECT *, CAST(NULL AS VARCHAR) AS route, CAST(NULL AS VARCHAR) AS location FROM stg_subway)
  UNION ALL SELECT {_UN} FROM (SELECT *, CAST(NULL AS VARCHAR) AS line_code, CAST(NULL AS VARCHAR) AS raw_station_name FROM stg_bus)
  UNION ALL SELECT {_UN} FROM (SELECT *, CAST(NULL AS VARCHAR) AS line_code, CAST(NULL AS VARCHAR) AS raw_station_name FROM stg_streetcar)""",
    "stg_subway", "stg_bus", "stg_streetcar")
cte("delays_enriched", """
  SELECT d.*, sm.canonical_station_name, sm.station_key AS station_id, dc.delay_description, dc.delay_category,
         CAST(strftime(d.delay_date, '%Y%m%d') AS INTEGER) AS date_key
  FROM delays_unioned d
  LEFT JOIN station_mapping sm ON d.raw_station_name = sm.raw_station_name
  LEFT JOIN delay_codes dc ON d.delay_code = dc.delay_code""", "delays_unioned", "station_mapping", "delay_codes")
cte("trips_enriched", """
  SELECT t.*, s.latitude AS start_latitude, s.longitude AS start_longitude, s.neighborhood AS start_neighborhood,
         e.latitude AS end_latitude, e.longitude AS end_longitude, e.neighborhood AS end_neighborhood,
         CAST(t.start_time AS DATE) AS trip_date,
         CAST(strftime(CAST(t.start_time AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         CASE WHEN t.trip_duration_seconds < 300 THEN 'Under 5 min'
              WHEN t.trip_duration_seconds < 900 THEN '5-15 min'
              WHEN t.trip_duration_seconds < 1800 THEN '15-30 min'
              WHEN t.trip_duration_seconds < 3600 THEN '30-60 min' ELSE 'Over 60 min' END AS duration_bucket
  FROM stg_trips t
  LEFT JOIN bike_station_ref s ON t.start_station_id = s.station_id
  LEFT JOIN bike_station_ref e ON t.end_station_id = e.station_id""", "stg_trips", "bike_station_ref")
cte("daily_transit", """
  SELECT delay_date, date_key, count(*) AS total_delay_incidents,
         sum(delay_minutes)::BIGINT AS total_delay_minutes, round(avg(delay_minutes), 2) AS avg_delay_minutes,
         sum(gap_minutes)::BIGINT AS total_gap_minutes,
         count_if(transit_mode = 'subway')::BIGINT AS subway_delay_incidents,
         count_if(transit_mode = 'bus')::BIGINT AS bus_delay_incidents,
         count_if(transit_mode = 'streetcar')::BIGINT AS streetcar_delay_incidents,
         sum(CASE WHEN transit_mode = 'subway' THEN delay_minutes ELSE 0 END)::BIGINT AS subway_delay_minutes,
         sum(CASE WHEN transit_mode = 'bus' THEN delay_minutes ELSE 0 END)::BIGINT AS bus_delay_minutes,
         sum(CASE WHEN transit_mode = 'streetcar' THEN delay_minutes ELSE 0 END)::BIGINT AS streetcar_delay_minutes
  FROM delays_enriched GROUP BY delay_date, date_key""", "delays_enriched")
cte("daily_bike", """
  SELECT trip_date, date_key, count(*) AS total_trips,
         sum(trip_duration_seconds)::BIGINT AS total_duration_seconds,
         round(avg(trip_duration_seconds), 2) AS avg_duration_seconds,
         count_if(user_type = 'Annual Member')::BIGINT AS member_trips,
         count_if(user_type = 'Casual Member')::BIGINT AS casual_trips
  FROM trips_enriched GROUP BY trip_date, date_key""", "trips_enriched")

# --- marts ------------------------------------------------------------------------
cte("date_bounds", """
  SELECT make_date(year(min(d)), 1, 1) AS lo, make_date(year(max(d)), 12, 31) AS hi FROM (
    SELECT delay_date AS d FROM stg_subway UNION ALL SELECT delay_date FROM stg_bus
    UNION ALL SELECT delay_date FROM stg_streetcar UNION ALL SELECT CAST(start_time AS DATE) FROM stg_trips)""",
    "stg_subway", "stg_bus", "stg_streetcar", "stg_trips")
cte("spine", """
  SELECT CAST(g.generate_series AS DATE) AS full_date
  FROM date_bounds, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) g""",
    "date_bounds")


def _nth_monday(y: str, month: int, n: int) -> str:
    first = f"make_date({y}, {month}, 1)"
    return f"({first} + CAST((8 - isodow({first})) % 7 + {7 * (n - 1)} AS INTEGER))"


def _easter(y: str) -> str:
    return (f"(SELECT make_date({y}, CAST(t // 31 AS INTEGER), CAST(t % 31 + 1 AS INTEGER)) FROM ("
            f"SELECT h + el - 7 * ((a + 11 * h + 22 * el) // 451) + 114 AS t FROM ("
            f"SELECT a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS el FROM ("
            f"SELECT a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM ("
            f"SELECT {y} % 19 AS a, {y} // 100 AS b, {y} % 100 AS c, ({y} // 100) // 4 AS d, ({y} // 100) % 4 AS e, "
            f"(({y} // 100) - (({y} // 100) + 8) // 25 + 1) // 3 AS g, ({y} % 100) // 4 AS i, ({y} % 100) % 4 AS k)))))")


_hol = []
for _name, _month, _rule, _arg in C.HOLIDAYS:
    if _rule == "fixed":
        _d = f"make_date(y, {_month}, {_arg})"
    elif _rule == "nth_monday":
        _d = _nth_monday("y", _month, _arg)
    elif _rule == "easter":
        _d = f"({_easter('y')} + {_arg})"
    else:
        _d = f"(make_date(y, {_month}, {_arg}) - CAST(isodow(make_date(y, {_month}, {_arg})) - 1 AS INTEGER))"
    _hol.append(f"SELECT {_q(_name)} AS holiday_name, CAST({_d} AS DATE) AS holiday_date FROM years")
cte("years", "SELECT DISTINCT CAST(year(full_date) AS INTEGER) AS y FROM spine", "spine")
cte("holidays", " UNION ALL ".join(_hol), "years")
cte("dim_date", """
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         dayname(full_date) AS day_of_week, CAST(isodow(full_date) AS INTEGER) AS day_of_week_num,
         CAST(month(full_date) AS INTEGER) AS month_num, monthname(full_date) AS month_name,
         CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
         isodow(full_date) >= 6 AS is_weekend,
         full_date IN (SELECT holiday_date FROM holidays) AS is_holiday
  FROM spine""", "spine", "holidays")
cte("dim_station", f"""
  SELECT {_sk("'TTC_SUBWAY'", 's.station_id')} AS station_key, s.station_id, s.station_name,
         'TTC_SUBWAY' AS station_type, c.latitude, c.longitude, CAST(NULL AS VARCHAR) AS neighborhood
  FROM (SELECT DISTINCT station_key AS station_id, canonical_station_name AS station_name FROM station_mapping) s
  LEFT JOIN subway_coords c ON s.station_name = c.canonical_station_name
  UNION ALL
  SELECT {_sk("'BIKE_SHARE'", 'CAST(station_id AS VARCHAR)')}, CAST(station_id AS VARCHAR), station_name,
         'BIKE_SHARE', latitude, longitude, neighborhood
  FROM bike_station_ref""", "station_mapping", "subway_coords", "bike_station_ref")
cte("dim_weather", """
  SELECT CAST(strftime(weather_date, '%Y%m%d') AS INTEGER) AS date_key, weather_date, mean_temp_c, max_temp_c,
         min_temp_c, total_precip_mm, total_rain_mm, total_snow_cm, snow_on_ground_cm, max_wind_gust_kmh,
         max_wind_gust_dir_deg,
         CASE WHEN total_snow_cm > 0 THEN 'Snow'
              WHEN total_rain_mm > 0 AND (total_snow_cm = 0 OR total_snow_cm IS NULL) THEN 'Rain'
              ELSE 'Clear' END AS weather_condition
  FROM stg_weather""", "stg_weather")
cte("dim_delay_codes", f"""
  SELECT {_sk('delay_code')} AS delay_code_key, delay_code, delay_description, delay_category FROM delay_codes""",
    "delay_codes")
cte("fct_transit_delays", f"""
  SELECT {_sk('transit_mode', 'delay_sk')} AS delay_sk, date_key,
         CASE WHEN transit_mode = 'subway' AND station_id IS NOT NULL THEN {_sk("'TTC_SUBWAY'", 'station_id')} END AS station_key,
         CASE WHEN delay_code IS NOT NULL THEN {_sk('delay_code')} END AS delay_code_key,
         delay_minutes, gap_minutes, transit_mode, line_code, direction, incident_timestamp
  FROM delays_enriched""", "delays_enriched")
cte("fct_bike_trips", f"""
  SELECT trip_sk, date_key,
         CASE WHEN start_latitude IS NOT NULL THEN {_sk("'BIKE_SHARE'", 'CAST(start_station_id AS VARCHAR)')} END AS start_station_key,
         CASE WHEN end_latitude IS NOT NULL THEN {_sk("'BIKE_SHARE'", 'CAST(end_station_id AS VARCHAR)')} END AS end_station_key,
         trip_duration_seconds AS duration_seconds, user_type, bike_id, start_time, end_time
  FROM trips_enriched""", "trips_enriched")
cte("fct_daily_mobility", """
  SELECT coalesce(t.date_key, b.date_key) AS date_key, t.total_delay_incidents, t.total_delay_minutes,
         t.avg_delay_minutes, t.total_gap_minutes, t.subway_delay_incidents, t.bus_delay_incidents,
         t.streetcar_delay_incidents, t.subway_delay_minutes, t.bus_delay_minutes, t.streetcar_delay_minutes,
         b.total_trips AS total_bike_trips, b.total_duration_seconds AS total_bike_duration_seconds,
         b.avg_duration_seconds AS avg_bike_duration_seconds, b.member_trips, b.casual_trips
  FROM daily_transit t FULL OUTER JOIN daily_bike b ON t.date_key = b.date_key""", "daily_transit", "daily_bike")


def sql(final: str, *needs: str) -> str:
    """``WITH`` + the CTEs ``needs`` depend on (topologically) + ``final``."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    if not order:
        return final
    head = final.lstrip()
    if head[:4].upper() == "WITH":
        return f"WITH {body},\n{head[4:]}"
    return f"WITH {body}\n{final}"
