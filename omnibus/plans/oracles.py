"""SQL counterparts of the catalog, written for DuckDB on the same test tables.

Each statement inlines the inputs it needs as common table expressions; they
are written independently of the Spark expressions.
"""

from __future__ import annotations

# Average of the moving speeds, half up at two decimals.  Speeds lie on a quarter grid, so hundredfold sums
# are integers and the rounding is exact; rounding the binary average would turn some halves down.
_MOVING = "derived_speed_kmh > 2 AND derived_speed_kmh <= 120"
_MOVING_AVG = f"""
               ((2 * CAST(sum(derived_speed_kmh) FILTER (WHERE {_MOVING}) * 100 AS BIGINT)
                 + count(*) FILTER (WHERE {_MOVING})) // nullif(2 * count(*) FILTER (WHERE {_MOVING}), 0)) / 100.0::DOUBLE"""

INPUTS: dict[str, str] = {
    # --- landed schedule files
    "copies": "SELECT * FROM (VALUES (0), (1)) AS v(copy)",
    "raw_routes": """
        SELECT CAST(c_custkey AS VARCHAR) AS route_id,
               CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ''
                    ELSE 'R' || c_custkey END AS route_short_name,
               c_name AS route_long_name,
               CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 3 END AS route_type
        FROM customer JOIN copies ON copy = 0 OR c_custkey % 29 = 0""",
    "silver_routes": "SELECT DISTINCT * FROM raw_routes",
    "raw_stops": """
        SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name,
               CASE WHEN p_partkey % 31 = 0 THEN NULL
                    ELSE CAST('28.' || (400 + p_partkey % 500) AS DOUBLE) END AS stop_lat,
               CAST(((76800 + p_partkey % 700) // 1000) || '.' ||
                    lpad(CAST((76800 + p_partkey % 700) % 1000 AS VARCHAR), 3, '0') AS DOUBLE) AS stop_lon
        FROM part""",
    "raw_trips": """
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
               CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE o_orderpriority END AS service_id,
               'S' || (o_orderkey % 97) AS shape_id
        FROM orders""",
    "calendar": """
        SELECT o_orderpriority AS service_id, max(o_orderkey) AS k FROM orders GROUP BY 1""",
    "silver_trips": """
        SELECT t.trip_id, t.route_id, t.service_id, t.shape_id,
               CAST(k & 1 AS INT) AS monday, CAST((k >> 1) & 1 AS INT) AS tuesday,
               CAST((k >> 2) & 1 AS INT) AS wednesday, CAST((k >> 3) & 1 AS INT) AS thursday,
               CAST((k >> 4) & 1 AS INT) AS friday, CAST((k >> 5) & 1 AS INT) AS saturday,
               CAST((k >> 6) & 1 AS INT) AS sunday,
               CASE WHEN k IS NOT NULL THEN '20240101' END AS start_date,
               CASE WHEN k IS NOT NULL THEN '20261231' END AS end_date
        FROM raw_trips t LEFT JOIN calendar c ON t.service_id = c.service_id""",
    "silver_schedule": """
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_partkey AS VARCHAR) AS stop_id,
               CASE WHEN l_partkey % 101 = 0 THEN '' WHEN l_partkey % 103 = 0 THEN 'soon'
                    ELSE lpad(CAST((l_orderkey * 7 + l_linenumber) % 27 AS VARCHAR), 2, '0') || ':' ||
                         lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0') || ':00' END AS arrival_time,
               CAST(CASE WHEN l_partkey % 101 <> 0 AND l_partkey % 103 <> 0
                    THEN (l_orderkey * 7 + l_linenumber) % 27 END AS INT) AS departure_hour,
               CAST(CASE WHEN l_partkey % 101 <> 0 AND l_partkey % 103 <> 0
                    THEN (l_orderkey * 7 + l_linenumber) % 27 * 3600 + l_suppkey % 60 * 60 END AS INT) AS secs,
               CASE WHEN l_partkey % 101 <> 0 AND l_partkey % 103 <> 0
                     AND (l_orderkey * 7 + l_linenumber) % 27 IN (7, 8, 9, 17, 18, 19)
                    THEN 1 ELSE 0 END AS is_peak_hour
        FROM lineitem""",
    # --- star tables
    "dim_route": """
        SELECT CAST(c_custkey AS VARCHAR) AS route_id,
               CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ''
                    ELSE 'R' || c_custkey END AS route_short_name,
               CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE c_name END AS route_long_name,
               3 AS route_type
        FROM customer""",
    "dim_stop": """
        SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name FROM part""",
    "dim_trip": """
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
               CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS route_id,
               o_orderpriority AS service_id, 'S' || (o_orderkey % 97) AS shape_id,
               o_orderkey & 1 AS monday, (o_orderkey >> 1) & 1 AS tuesday,
               (o_orderkey >> 2) & 1 AS wednesday, (o_orderkey >> 3) & 1 AS thursday,
               (o_orderkey >> 4) & 1 AS friday, (o_orderkey >> 5) & 1 AS saturday,
               (o_orderkey >> 6) & 1 AS sunday
        FROM orders""",
    "fact_schedule": """
        SELECT CASE WHEN l_partkey % 43 = 0 THEN 'X' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS trip_id,
               CAST(l_partkey AS VARCHAR) AS stop_id, h AS departure_hour,
               CASE WHEN l_partkey % 37 = 0 THEN NULL
                    WHEN h IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_peak_hour
        FROM (SELECT *, CAST(CASE WHEN l_partkey % 101 = 0 THEN NULL
                             ELSE (l_orderkey * 7 + l_linenumber) % 27 END AS INT) AS h FROM lineitem)""",
    "fact_vehicle_positions": """
        SELECT 'E' || event_id AS entity_id, CAST(user_id AS VARCHAR) AS vehicle_id,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'unknown'
                    ELSE CAST(user_id AS VARCHAR) END AS route_id,
               CASE WHEN event_id % 10 = 0 THEN 0.0::DOUBLE ELSE floor(value * 4) / 4 END AS speed,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS "timestamp",
               event_id % 3 AS status,
               CASE WHEN event_id % 47 = 0 THEN 'late' ELSE strftime(ts, '%Y-%m-%dT%H:%M:00') END AS ingested_at,
               CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 2.0::DOUBLE
                    ELSE floor(value * 4) / 4 END AS derived_speed_kmh,
               CAST(ts AS DATE) AS ping_date, CAST(hour(ts) AS INT) AS ping_hour
        FROM events""",
    "weather": """
        SELECT date, (25 + k % 17)::DOUBLE AS temp_max_c, (15 + k % 17)::DOUBLE AS temp_min_c,
               (20 + k % 17) / 2.0::DOUBLE AS temp_avg_c, (k % 40) / 4.0::DOUBLE AS precipitation_mm,
               (k % 50)::DOUBLE AS windspeed_max_kmh, CAST(k % 100 AS INT) AS weather_code,
               CASE k % 3 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Drizzle/Rain' END AS weather_label,
               CASE WHEN k % 3 = 1 THEN 1 ELSE 0 END AS is_rainy_day
        FROM (SELECT DATE '2024-01-01' + CAST(o_orderkey % 45 AS INT) AS date, max(o_custkey) AS k
              FROM orders GROUP BY 1)""",
    "silver_weather": """
        SELECT CAST(date AS VARCHAR) AS date, temp_max_c, temp_min_c,
               (temp_max_c + temp_min_c) / 2 AS temp_avg_c, precipitation_mm, windspeed_max_kmh, weather_code,
               CASE WHEN weather_code = 0 THEN 'Clear'
                    WHEN weather_code BETWEEN 1 AND 3 THEN 'Cloudy'
                    WHEN weather_code BETWEEN 45 AND 48 THEN 'Fog'
                    WHEN weather_code BETWEEN 51 AND 67 OR weather_code BETWEEN 80 AND 82 THEN 'Drizzle/Rain'
                    WHEN weather_code BETWEEN 71 AND 77 OR weather_code BETWEEN 85 AND 86 THEN 'Snow'
                    WHEN weather_code BETWEEN 95 AND 99 THEN 'Thunderstorm' END AS weather_label,
               CASE WHEN precipitation_mm > 0 THEN 1 ELSE 0 END AS is_rainy_day
        FROM weather""",
    "fuel": """
        SELECT date, 90 + (hi % 40) / 4.0::DOUBLE AS petrol_delhi_inr,
               80 + (lo % 40) / 4.0::DOUBLE AS diesel_delhi_inr, 'seed' AS source_note
        FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
                     max(o_orderkey) AS hi, min(o_orderkey) AS lo FROM orders GROUP BY 1)""",
    "holidays": "SELECT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_totalprice > 440000",
    "date_bounds": """
        SELECT least((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
                     (SELECT min(date) FROM weather)) AS lo,
               greatest((SELECT max(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders),
                        (SELECT max(date) FROM weather)) AS hi""",
    "dim_date": """
        SELECT CAST(d AS DATE) AS date
        FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM date_bounds)""",
    "user_route_access": """
        SELECT 'user' || c_nationkey AS user_email, CAST(c_custkey AS VARCHAR) AS route_id FROM customer""",
    "own_routes": "SELECT route_id FROM user_route_access WHERE user_email = 'user7'",
    # --- gold
    "served": """
        SELECT r.route_id, r.route_short_name, r.route_long_name, s.trip_id, s.stop_id, s.is_peak_hour, s.departure_hour
        FROM fact_schedule s JOIN dim_trip t ON s.trip_id = t.trip_id JOIN dim_route r ON t.route_id = r.route_id""",
    "route_summary": """
        SELECT route_id, coalesce(route_short_name, route_long_name) AS route_name,
               count(DISTINCT trip_id) AS total_trips, count(trip_id) AS total_stop_events,
               CAST(sum(is_peak_hour) AS BIGINT) AS peak_hour_stops,
               count(*) FILTER (WHERE is_peak_hour = 0) AS offpeak_stops,
               CAST(CAST(round(100.0 * sum(is_peak_hour) / nullif(count(trip_id), 0), 1) AS DECIMAL(5,1)) AS DOUBLE)
                 AS peak_hour_pct,
               count(DISTINCT stop_id) AS unique_stops_served
        FROM served GROUP BY route_id, route_short_name, route_long_name""",
    "top_routes": """
        SELECT route_id, coalesce(route_short_name, route_long_name) AS route_name,
               count(DISTINCT trip_id) AS scheduled_trips, count(stop_id) AS total_stop_events,
               count(DISTINCT stop_id) AS unique_stops, CAST(sum(is_peak_hour) AS BIGINT) AS peak_events
        FROM served GROUP BY route_id, route_short_name, route_long_name
        ORDER BY scheduled_trips DESC, route_id LIMIT 50""",
    "hourly": """
        SELECT departure_hour AS hour_of_day, count(*) AS total_departures,
               count(DISTINCT trip_id) AS unique_trips, CAST(sum(is_peak_hour) AS BIGINT) AS is_peak_hour,
               CASE WHEN departure_hour BETWEEN 7 AND 9 THEN 'Morning Peak'
                    WHEN departure_hour BETWEEN 17 AND 19 THEN 'Evening Peak'
                    WHEN departure_hour BETWEEN 10 AND 16 THEN 'Mid-day'
                    WHEN departure_hour BETWEEN 20 AND 23 THEN 'Night' ELSE 'Early Morning' END AS time_slot
        FROM fact_schedule GROUP BY departure_hour""",
    "activity": f"""
        SELECT v.route_id, r.route_long_name AS route_name, v.ping_hour AS activity_hour,
               CAST(v.ping_date AS VARCHAR) AS activity_date, count(*) AS position_pings,
               count(DISTINCT v.vehicle_id) AS unique_vehicles,
               {_MOVING_AVG} AS avg_speed_kmh,
               count(*) FILTER (WHERE derived_speed_kmh < 2) AS stopped_pings,
               CAST(round(100.0 * count(*) FILTER (WHERE derived_speed_kmh < 2) / nullif(count(*), 0), 1) AS DOUBLE)
                 AS pct_stopped
        FROM fact_vehicle_positions v LEFT JOIN dim_route r ON v.route_id = r.route_id
        WHERE v.ping_date >= DATE '2024-01-10'
        GROUP BY v.route_id, r.route_long_name, v.ping_hour, v.ping_date""",
    "rain_summary": """
        SELECT weather_label, count(*) AS total_days, round(avg(temp_avg_c), 1) AS avg_temp_c,
               round(avg(precipitation_mm), 2) AS avg_rain_mm, round(max(precipitation_mm), 2) AS max_rain_mm,
               round(avg(windspeed_max_kmh), 1) AS avg_wind_kmh, CAST(sum(is_rainy_day) AS BIGINT) AS rainy_days
        FROM weather GROUP BY weather_label""",
    "impact": f"""
        SELECT CAST(w.date AS VARCHAR) AS date, w.weather_label, w.is_rainy_day, w.precipitation_mm, w.temp_avg_c,
               count(v.vehicle_id) AS total_pings, count(DISTINCT v.vehicle_id) AS active_buses,
               {_MOVING_AVG} AS avg_speed_kmh,
               count(*) FILTER (WHERE derived_speed_kmh < 2) AS stopped_pings,
               CAST(round(100.0 * count(*) FILTER (WHERE derived_speed_kmh < 2) / nullif(count(*), 0), 1) AS DOUBLE)
                 AS pct_stopped
        FROM weather w LEFT JOIN fact_vehicle_positions v ON v.ping_date = w.date
        GROUP BY w.date, w.weather_label, w.is_rainy_day, w.precipitation_mm, w.temp_avg_c""",
    # --- realtime feed
    "raw_positions": """
        SELECT 'E' || event_id || CASE WHEN copy = 1 THEN 'b' ELSE '' END AS entity_id,
               CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 1000 AS VARCHAR) AS trip_id,
               CAST(user_id % 50 AS VARCHAR) AS route_id,
               CASE WHEN event_id % 23 = 0 THEN 0.0::DOUBLE WHEN event_id % 31 = 0 THEN NULL
                    ELSE 28.4::DOUBLE + (event_id * 37 % 500) / 1000.0::DOUBLE END AS latitude,
               CASE WHEN event_id % 23 = 0 THEN 0.0::DOUBLE WHEN event_id % 31 = 0 THEN NULL
                    ELSE 76.8::DOUBLE + (event_id * 53 % 700) / 1000.0::DOUBLE END AS longitude,
               floor(value * 4) / 4 AS speed,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS "timestamp",
               CAST(event_id % 3 AS INT) AS status,
               CASE WHEN event_id % 47 = 0 THEN 'late'
                    ELSE strftime(ts + to_minutes(copy), '%Y-%m-%dT%H:%M:00') END AS ingested_at,
               CAST(date_trunc('second', ts) AS TIMESTAMP) AS wall
        FROM events JOIN copies ON copy = 0 OR event_id % 29 = 0""",
    "inside": """
        SELECT * FROM raw_positions WHERE latitude BETWEEN 28.0 AND 29.1 AND longitude BETWEEN 76.5 AND 78.0""",
    "clean": """
        SELECT * FROM inside
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, "timestamp" ORDER BY ingested_at, entity_id) = 1""",
    "hops": """
        SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon,
               epoch(wall) - epoch(lag(wall) OVER w) AS dt
        FROM clean WINDOW w AS (PARTITION BY vehicle_id ORDER BY wall)""",
    "speeds": """
        SELECT *, CASE WHEN dt > 0 THEN
               2 * 6371.0088 * asin(sqrt(pow(sin(radians(latitude - plat) / 2), 2)
                 + cos(radians(plat)) * cos(radians(latitude)) * pow(sin(radians(longitude - plon) / 2), 2)))
               * 3600 / dt END AS kmh
        FROM hops""",
    # --- field observations
    "qr_codes": """
        SELECT s_suppkey AS id, CAST(s_suppkey AS VARCHAR) AS qr_token, 'B' || s_suppkey AS bus_number,
               CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(s_suppkey % 30 AS VARCHAR) END AS route_id,
               s_suppkey % 10 <> 0 AS is_active
        FROM supplier""",
    "problem_types": """
        SELECT ['BUS_DELAY', 'BUS_NOT_ARRIVED', 'BUS_BUNCHING', 'LONG_SERVICE_GAP', 'OVER_CROWDING',
                'UNDER_UTILIZATION', 'VEHICLE_CONDITION', 'VEHICLE_BREAKDOWN', 'MAINTENANCE_ISSUE',
                'FUEL_CONSUMPTION', 'SAFETY_ISSUE', 'ROUTE_ISSUE', 'STOP_INFRASTRUCTURE',
                'WEATHER_DISRUPTION', 'TRAFFIC_DISRUPTION', 'OTHER'] AS kinds,
               ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'] AS levels, ['NEW', 'REVIEWED', 'RESOLVED'] AS states""",
    "submissions": """
        SELECT event_id AS id,
               CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(user_id % 20 AS VARCHAR) END AS qr_token,
               CASE WHEN event_id % 101 = 0 THEN '' ELSE 'anon' || (user_id % 5) END AS anonymous_identifier,
               event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 17 = 16 OR event_id % 89 = 0
                 OR event_id % 79 = 0 OR event_id % 83 = 0 AS bad,
               ts AS created_at
        FROM events""",
    "screened": """
        SELECT s.*, q.id AS qr_code_id, q.bus_number, q.route_id,
               CASE WHEN bad THEN 'invalid' WHEN q.id IS NULL THEN 'unknown_token'
                    WHEN NOT q.is_active THEN 'inactive_token' END AS verdict
        FROM submissions s LEFT JOIN qr_codes q ON s.qr_token = q.qr_token""",
    "observations": """
        SELECT event_id AS id, 'B' || (user_id % 20) AS bus_number,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 50 AS VARCHAR) END AS route_id,
               kinds[event_id * 7 % 16 + 1] AS problem_type, levels[event_id * 3 % 5 % 4 + 1] AS severity,
               CASE WHEN event_id % 6 = 0 THEN NULL
                    ELSE 'said "hi", line' || chr(10) || event_id END AS description,
               states[event_id % 3 + 1] AS status, ts AS created_at,
               28.4::DOUBLE + (event_id * 37 % 500) / 1000.0::DOUBLE AS latitude,
               76.8::DOUBLE + (event_id * 53 % 700) / 1000.0::DOUBLE AS longitude
        FROM events, problem_types""",
    "window_counts": """
        SELECT route_id, problem_type, severity, count(id) AS n FROM observations
        WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY GROUP BY ALL""",
    "by_route": """
        SELECT route_id, problem_type, severity, n FROM window_counts WHERE route_id IS NOT NULL
        ORDER BY n DESC, route_id, problem_type, severity LIMIT 50""",
}


def _needed(sql: str, seen: list[str]) -> None:
    import re

    words = set(re.findall(r"[a-z_]+", sql))
    for name in INPUTS:
        if name in words and name not in seen:
            _needed(INPUTS[name], seen)
            if name not in seen:
                seen.append(name)


def _with_inputs(sql: str, recursive: str = "") -> str:
    """The statement with the inputs it mentions, in dependency order."""
    seen: list[str] = []
    _needed(recursive + sql, seen)
    parts = [f"{name} AS ({INPUTS[name].strip()})" for name in seen]
    if recursive:
        parts.append(recursive.strip())
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    return f"{keyword} {', '.join(parts)} {sql.strip()}" if parts else sql.strip()


def _spaced(source: str) -> str:
    """The rows of ``source`` kept by the 60-minute rule, one kept row after another."""
    return f"""
      kept AS (
        SELECT qr_code_id, anonymous_identifier, id, created_at FROM (
          SELECT *, row_number() OVER (PARTITION BY qr_code_id, anonymous_identifier ORDER BY created_at, id) AS rn
          FROM {source}) WHERE rn = 1
        UNION ALL
        SELECT * FROM (
          SELECT s.qr_code_id, s.anonymous_identifier, s.id, s.created_at
          FROM kept k JOIN {source} s ON s.qr_code_id = k.qr_code_id
            AND s.anonymous_identifier = k.anonymous_identifier
            AND s.created_at > k.created_at + INTERVAL 60 MINUTE
          QUALIFY row_number() OVER (PARTITION BY s.qr_code_id, s.anonymous_identifier
                                     ORDER BY s.created_at, s.id) = 1)
      )"""


_PENDING = "pending AS (SELECT * FROM screened WHERE verdict IS NULL),"
_KEYED = """keyed AS (SELECT id, (id * 31) % 7 AS qr_code_id, anonymous_identifier, created_at FROM submissions),"""


def _avg(column: str) -> str:
    return f"round(avg({column}) + 1e-9, 6) AS avg_{column}"


def _total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS sum_{column}"


def _rsum(column: str) -> str:
    return f"round(sum({column}) + 1e-9, 6) AS sum_{column}"


_TOP = """
    SELECT route_name, sum_scheduled_trips FROM (
      SELECT *, rank() OVER (ORDER BY sum_scheduled_trips DESC) AS r FROM (
        SELECT route_name, CAST(sum(scheduled_trips) AS BIGINT) AS sum_scheduled_trips
        FROM top_routes GROUP BY route_name)) WHERE r <= {n}"""
_PICK_ROUTE = "SELECT DISTINCT route_long_name FROM dim_route"
_DAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
_V11 = "SELECT " + ", ".join(_total(d) for d in _DAYS) + " FROM dim_trip"
_V20 = f"""SELECT route_name, {_total('total_trips')}, {_total('unique_stops_served')}, {_avg('peak_hour_pct')}
           FROM route_summary {{where}} GROUP BY route_name"""
_V30 = f"""SELECT route_name, {_total('position_pings')}, {_total('unique_vehicles')},
           {_avg('avg_speed_kmh')}, {_avg('pct_stopped')} FROM activity {{where}} GROUP BY route_name"""
_V33 = f"""SELECT vehicle_id, route_id, "timestamp", {_avg('speed')}, {_total('status')}
           FROM fact_vehicle_positions {{where}} GROUP BY ALL"""
_NAMED = "WHERE route_id IN (SELECT route_id FROM dim_route WHERE route_long_name IS NOT NULL)"
_OWN = "WHERE route_id IN (SELECT route_id FROM own_routes)"
_RAINY = "WHERE weather_label = 'Drizzle/Rain'"
_V07 = f"SELECT weather_label, {_total('total_days')} FROM rain_summary GROUP BY 1"
_V40 = "SELECT date, round(avg(precipitation_mm) + 1e-9, 6) AS avg_precipitation_mm FROM impact GROUP BY date"

_VISUALS = {
    "v01": f"SELECT hour_of_day, time_slot, {_total('total_departures')} FROM hourly GROUP BY 1, 2",
    "v02": f"SELECT {_avg('avg_speed_kmh')} FROM activity",
    "v03": f"SELECT {_total('total_stop_events')} FROM route_summary",
    "v04": f"SELECT CAST(date AS VARCHAR) AS date, {_avg('petrol_delhi_inr')}, {_avg('diesel_delhi_inr')} FROM fuel GROUP BY date",
    "v05": "SELECT count(DISTINCT route_id) AS count_distinct_route_id FROM route_summary",
    "v06": _TOP.format(n=10),
    "v07": _V07,
    "v08": _PICK_ROUTE,
    "v09": f"SELECT {_total('offpeak_stops')}, {_total('peak_hour_stops')} FROM route_summary",
    "v10": f"SELECT {_total('total_trips')} FROM route_summary",
    "v11": _V11,
    "v12": f"SELECT hour_of_day, {_total('total_departures')} FROM hourly GROUP BY 1",
    "v13": f"SELECT {_total('total_trips')} FROM route_summary",
    "v14": "SELECT DISTINCT time_slot FROM hourly",
    "v15": _TOP.format(n=20),
    "v16": "SELECT time_slot, count(DISTINCT total_departures) AS count_distinct_total_departures FROM hourly GROUP BY 1",
    "v17": f"{_PICK_ROUTE} WHERE route_long_name IS NOT NULL",
    "v18": f"SELECT {_avg('peak_hour_pct')} FROM route_summary",
    "v19": f"SELECT {_total('unique_stops_served')} FROM route_summary",
    "v20": _V20.format(where=""),
    "v21": f"SELECT {_avg('avg_speed_kmh')} FROM activity",
    "v22": """SELECT stopped_pings, CAST(sum(position_pings) - sum(stopped_pings) AS BIGINT) AS not_stopped_pings
              FROM activity GROUP BY 1""",
    "v23": _PICK_ROUTE,
    "v24": f"SELECT activity_hour, {_total('position_pings')} FROM activity GROUP BY 1",
    "v25": f"SELECT {_total('position_pings')} FROM activity",
    "v26": f"SELECT {_total('unique_vehicles')} FROM activity",
    "v27": "SELECT DISTINCT activity_hour FROM activity",
    "v28": f"SELECT route_name, {_avg('avg_speed_kmh')} FROM activity GROUP BY 1",
    "v29": f"SELECT {_avg('pct_stopped')} FROM activity",
    "v30": _V30.format(where=""),
    "v31": "SELECT DISTINCT round(speed + 1e-9, 6) AS speed FROM fact_vehicle_positions",
    "v32": "SELECT count(entity_id) AS count_entity_id FROM fact_vehicle_positions",
    "v33": _V33.format(where=""),
    "v34": "SELECT route_name, count(DISTINCT stopped_pings) AS count_distinct_stopped_pings FROM activity GROUP BY 1",
    "v35": """SELECT round(speed + 1e-9, 6) AS speed, count(vehicle_id) AS count_vehicle_id
              FROM fact_vehicle_positions WHERE speed = 0 GROUP BY 1""",
    "v36": "SELECT count(DISTINCT vehicle_id) AS count_distinct_vehicle_id FROM fact_vehicle_positions",
    "v37": f'SELECT "timestamp", {_avg("speed")} FROM fact_vehicle_positions GROUP BY 1',
    "v38": _PICK_ROUTE,
    "v39": f"SELECT {_avg('speed')} FROM fact_vehicle_positions",
    "v40": _V40,
    "v41": "SELECT DISTINCT CAST(date AS VARCHAR) AS date FROM dim_date",
    "v42": "SELECT date, round(avg(temp_avg_c) + 1e-9, 6) AS avg_temp_avg_c FROM impact GROUP BY date",
    "v43": _V07,
    "v44": f"""SELECT weather_label, {_rsum('avg_rain_mm')}, {_rsum('avg_temp_c')}, {_rsum('avg_wind_kmh')},
               {_rsum('max_rain_mm')}, {_total('rainy_days')}, {_total('total_days')} FROM rain_summary GROUP BY 1""",
    "v45": "SELECT count(DISTINCT date) AS count_distinct_date FROM weather",
    "v46": "SELECT round(max(precipitation_mm) + 1e-9, 6) AS max_precipitation_mm FROM weather",
    "v47": _V40,
    "v48": f"SELECT {_avg('temp_avg_c')} FROM weather",
    "v49": f"SELECT {_total('is_rainy_day')} FROM weather",
    "v50": "SELECT DISTINCT weather_label FROM weather",
    "v11_saved_slicer": f"{_V11} {_NAMED}",
    "v13_saved_slicer": f"SELECT {_total('total_trips')} FROM route_summary {_NAMED}",
    "v15_saved_slicer": _TOP.format(n=20).replace("FROM top_routes", f"FROM top_routes {_NAMED}"),
    "v18_saved_slicer": f"SELECT {_avg('peak_hour_pct')} FROM route_summary {_NAMED}",
    "v19_saved_slicer": f"SELECT {_total('unique_stops_served')} FROM route_summary {_NAMED}",
    "v20_saved_slicer": _V20.format(where=_NAMED),
    "v45_saved_slicer": f"SELECT count(DISTINCT date) AS count_distinct_date FROM weather {_RAINY}",
    "v46_saved_slicer": f"SELECT round(max(precipitation_mm) + 1e-9, 6) AS max_precipitation_mm FROM weather {_RAINY}",
    "v48_saved_slicer": f"SELECT {_avg('temp_avg_c')} FROM weather {_RAINY}",
    "v49_saved_slicer": f"SELECT {_total('is_rainy_day')} FROM weather {_RAINY}",
}

_EXPORT = """
    SELECT CAST(id AS VARCHAR) AS id, coalesce(route_id, '') AS route_id, coalesce(description, '') AS description,
           strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at"""
_LIST_TABLES = """
    SELECT 'dim_route' AS table_name, count(*) AS n_rows, count(route_id) AS n_first FROM dim_route
    UNION ALL SELECT 'dim_stop', count(*), count(*) FROM part
    UNION ALL SELECT 'dim_trip', count(*), count(*) FROM orders
    UNION ALL SELECT 'dim_date', count(*), count(*) FROM dim_date
    UNION ALL SELECT 'fact_schedule', count(*), count(*) FROM lineitem
    UNION ALL SELECT 'fact_weather_daily', count(*), count(*) FILTER (WHERE day(date) <> 5) FROM weather
    UNION ALL SELECT 'fact_fuel_prices', count(*), count(*) FROM fuel"""
_ORPHANS = """
    SELECT 'orphan fact_vehicle_positions.route_id' AS "check", count(*) AS violations FROM fact_vehicle_positions
      WHERE route_id IS NOT NULL AND route_id NOT IN (SELECT route_id FROM dim_route)
    UNION ALL SELECT 'orphan dim_trip.route_id', count(*) FROM dim_trip
      WHERE route_id IS NOT NULL AND route_id NOT IN (SELECT route_id FROM dim_route)
    UNION ALL SELECT 'orphan fact_fuel_prices.date', count(*) FROM fuel
      WHERE date NOT IN (SELECT date FROM dim_date)
    UNION ALL SELECT 'orphan fact_weather_daily.date', count(*) FROM weather
      WHERE date NOT IN (SELECT date FROM dim_date)
    UNION ALL SELECT 'orphan fact_schedule.trip_id', count(*) FROM fact_schedule
      WHERE trip_id NOT IN (SELECT trip_id FROM dim_trip)
    UNION ALL SELECT 'orphan fact_schedule.stop_id', count(*) FROM fact_schedule
      WHERE stop_id NOT IN (SELECT stop_id FROM dim_stop)"""
_NULLS = """
    SELECT unnest(['null dim_route.route_id', 'null dim_stop.stop_id', 'null dim_trip.trip_id',
                   'null dim_date.date_key', 'null user_route_access.user_email',
                   'null user_route_access.route_id']) AS "check", CAST(0 AS BIGINT) AS violations"""
_SPEED = """
    SELECT 'speed bound' AS "check", count(*) AS violations FROM fact_vehicle_positions WHERE derived_speed_kmh > 120"""


def _lengths(table: str, source: str, limits: dict[str, int]) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'length {table}.{c}' AS "check", count(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {source}"""
        for c, n in limits.items()
    )


def _zeros(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""SELECT unnest([{listed}]) AS "check", CAST(0 AS BIGINT) AS violations"""


_READ_LENGTHS = " UNION ALL ".join([
    _lengths("dim_route", "dim_route", {"route_id": 50, "route_short_name": 20, "route_long_name": 255}),
    _lengths("dim_stop", "dim_stop", {"stop_id": 50, "stop_name": 255}),
    _lengths("dim_trip", "dim_trip", {"trip_id": 100, "route_id": 50, "service_id": 50, "shape_id": 50}),
    _lengths("fact_schedule", "fact_schedule", {"trip_id": 100, "stop_id": 50}),
    _lengths("fact_vehicle_positions", "fact_vehicle_positions",
             {"entity_id": 50, "vehicle_id": 50, "route_id": 50, '"timestamp"': 40, "ingested_at": 40}
             ).replace('_positions."timestamp"', "_positions.timestamp"),
    _lengths("fact_weather_daily", "weather", {"weather_label": 50}),
    _lengths("fact_fuel_prices", "fuel", {"source_note": 100}),
    _lengths("user_route_access", "user_route_access", {"user_email": 256, "route_id": 50}),
])
# Fixed-width columns of the analogs: 8-character dates and times, weekday names, small trip numbers.
_FIXED_WIDTH = _zeros(
    "length dim_trip.start_date", "length dim_trip.end_date", "length dim_date.month_name", "length dim_date.day_name",
    "length fact_schedule.arrival_time", "length fact_schedule.departure_time", "length fact_vehicle_positions.trip_id",
)
_LENGTHS = f"{_READ_LENGTHS} UNION ALL {_FIXED_WIDTH}"


def _counted(*checks: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", count(*) AS violations FROM {table} WHERE {bad}""" for name, table, bad in checks
    )


# The same columns and keys where the faulty star breaks their rules.
_OVERLONG = _counted(
    ("length dim_trip.start_date", "orders", "o_orderkey % 37 = 0"),
    ("length dim_trip.end_date", "orders", "o_orderkey % 41 = 0"),
    ("length dim_date.month_name", "dim_date", "month(date) = 2"),
    ("length dim_date.day_name", "dim_date", "day(date) = 7"),
    ("length fact_schedule.arrival_time", "lineitem", "l_linenumber = 3 AND l_partkey % 101 <> 0"),
    ("length fact_schedule.departure_time", "lineitem", "l_linenumber = 5 AND l_partkey % 101 <> 0"),
    ("length fact_vehicle_positions.trip_id", "events", "event_id % 3 = 1"),
)
_MISSING = _counted(
    ("null dim_route.route_id", "customer", "c_custkey % 61 = 0"),
    ("null dim_stop.stop_id", "part", "p_partkey % 67 = 0"),
    ("null dim_trip.trip_id", "orders", "o_orderkey % 71 = 0"),
    ("null dim_date.date_key", "dim_date", "day(date) = 13"),
    ("null user_route_access.user_email", "customer", "c_custkey % 73 = 0"),
    ("null user_route_access.route_id", "customer", "c_custkey % 79 = 0"),
)
_CALENDAR = """
    SELECT 'calendar fact_vehicle_positions' AS "check", count(*) AS violations FROM fact_vehicle_positions
      WHERE ping_date NOT IN (SELECT date FROM {cal})
    UNION ALL SELECT 'calendar fact_weather_daily', count(*) FROM weather WHERE date NOT IN (SELECT date FROM {cal})
    UNION ALL SELECT 'calendar fact_fuel_prices', count(*) FROM fuel WHERE date NOT IN (SELECT date FROM {cal})"""
_KEYS_UNIQUE = _zeros("unique dim_route.route_id", "unique dim_stop.stop_id", "unique dim_trip.trip_id", "unique dim_date.date")
_POSITION_KEYS = """
    SELECT 'unique ping' AS "check", count(*) AS violations FROM (
      SELECT vehicle_id, "timestamp" FROM {source} GROUP BY ALL HAVING count(*) > 1)"""

_STATEMENTS = {
    "g1_route_schedule_summary": "SELECT * FROM route_summary",
    "g2_top_routes": "SELECT * FROM top_routes",
    "g3_hourly_distribution": "SELECT * FROM hourly",
    "g4_vehicle_activity": "SELECT * FROM activity",
    "g5_weather_summary": "SELECT * FROM rain_summary",
    "g6_weather_vs_activity": "SELECT * FROM impact",
    **_VISUALS,
    "m1_not_stopped": "SELECT CAST(sum(position_pings) - sum(stopped_pings) AS BIGINT) AS not_stopped_pings FROM activity",
    "m2_filter_propagation": """
        SELECT departure_hour, count(*) AS events FROM fact_schedule WHERE trip_id IN (
          SELECT trip_id FROM dim_trip WHERE route_id IN (SELECT route_id FROM dim_route WHERE route_short_name = ''))
        GROUP BY 1""",
    "m3_slicers": f"""
        SELECT activity_hour, {_total('position_pings')} FROM activity WHERE activity_hour BETWEEN 6 AND 18
          AND route_id IN (SELECT route_id FROM dim_route WHERE route_type IN (3, 4) AND route_long_name IS NOT NULL)
        GROUP BY 1""",
    "m4_rls_route_summary": f"SELECT * FROM route_summary {_OWN}",
    "m4_rls_top_routes": f"SELECT * FROM top_routes {_OWN}",
    "m4_rls_schedule": f"""
        SELECT departure_hour, count(*) AS events FROM fact_schedule
        WHERE trip_id IN (SELECT trip_id FROM dim_trip {_OWN}) GROUP BY 1""",
    "m4_rls_positions": _V33.format(where=_OWN),
    "m4_rls_activity": _V30.format(where=_OWN),
    "m4_rls_access_table": "SELECT * FROM user_route_access WHERE user_email = 'user7'",
    "m4_rls_unmapped_user": """
        SELECT count(*) AS trips FROM dim_trip WHERE route_id IN (
          SELECT route_id FROM user_route_access WHERE user_email = 'USER7')""",
    "m4_rls_unreached_table": "SELECT * FROM hourly",
    "m5_open_role": _V30.format(where=""),
    "t01_dim_route": "SELECT * FROM silver_routes",
    "t02_dim_stop": "SELECT * FROM raw_stops",
    "t03_dim_trip": "SELECT * FROM silver_trips",
    "t04_dim_date": """
        SELECT CAST(strftime(date, '%Y%m%d') AS INT) AS date_key, CAST(date AS VARCHAR) AS date,
               CAST(year(date) AS INT) AS year, CAST(quarter(date) AS INT) AS quarter,
               CAST(month(date) AS INT) AS month, monthname(date) AS month_name,
               CAST(weekofyear(date) AS INT) AS week_of_year, CAST(day(date) AS INT) AS day_of_month,
               CAST(dayofweek(date) + 1 AS INT) AS day_of_week, dayname(date) AS day_name,
               CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN date IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_public_holiday
        FROM dim_date""",
    "t04_dim_date_iso": """
        SELECT CAST(strftime(date, '%Y%m%d') AS INT) AS date_key, CAST(isodow(date) AS INT) AS day_of_week,
               0 AS is_public_holiday FROM dim_date""",
    "t05_gtfs_seconds": """
        SELECT arrival_time, secs AS arrival_secs, secs AS departure_secs, departure_hour, count(*) AS n
        FROM silver_schedule GROUP BY ALL""",
    "t05_wrapped_hours": "SELECT departure_hour % 24 AS departure_hour, count(*) AS n FROM silver_schedule GROUP BY 1",
    "t06_peak_flag": "SELECT departure_hour, is_peak_hour, count(*) AS n FROM silver_schedule GROUP BY 1, 2",
    "t07_weather_features": "SELECT * FROM silver_weather",
    "t08_inside_city": "SELECT entity_id, latitude, longitude FROM inside",
    "t09_one_per_instant": """
        SELECT * EXCLUDE (wall) FROM raw_positions
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, "timestamp" ORDER BY ingested_at, entity_id) = 1""",
    "t10_derived_speed": """
        SELECT entity_id, vehicle_id, "timestamp", round(kmh + 1e-9, 3) AS derived_speed_kmh FROM speeds""",
    "t11_clamped_speed": """
        SELECT entity_id, CASE WHEN kmh <= 120 THEN round(kmh + 1e-9, 3) END AS derived_speed_kmh FROM speeds""",
    "t12_instants": """
        SELECT entity_id, strftime(wall - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS instant,
               CAST(hour(wall) AS INT) AS local_hour FROM raw_positions""",
    "t13_newer_rows": """
        SELECT entity_id, ingested_at FROM raw_positions
        WHERE TRY_CAST(ingested_at AS TIMESTAMP) > TIMESTAMP '2024-01-15'""",
    "t14_typed_observations": """
        SELECT id, coalesce(route_id, '') AS route_id, bus_number, problem_type, severity, status,
               coalesce(description, '') AS description, latitude, longitude,
               strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS observed_at,
               strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at
        FROM observations""",
    "s1_gtfs_scan": """
        SELECT 'routes' AS file, count(*) AS n_rows, count(DISTINCT route_id) AS n_keys FROM raw_routes
        UNION ALL SELECT 'stops', count(*), count(DISTINCT stop_id) FROM raw_stops
        UNION ALL SELECT 'trips', count(*), count(DISTINCT trip_id) FROM raw_trips
        UNION ALL SELECT 'stop_times', count(*), count(DISTINCT nullif(arrival_time, '')) FROM silver_schedule
        UNION ALL SELECT 'calendar', count(*), count(DISTINCT service_id) FROM calendar
        UNION ALL SELECT 'agency', count(*), count(*) FROM region""",
    "s1_files_to_gold": """
        SELECT r.route_id, coalesce(nullif(route_short_name, ''), route_long_name) AS route_name,
               count(DISTINCT t.trip_id) AS total_trips, count(s.trip_id) AS total_stop_events,
               CAST(sum(is_peak_hour) AS BIGINT) AS peak_hour_stops,
               count(*) FILTER (WHERE is_peak_hour = 0) AS offpeak_stops,
               CAST(CAST(round(100.0 * sum(is_peak_hour) / count(*), 1) AS DECIMAL(5,1)) AS DOUBLE) AS peak_hour_pct,
               count(DISTINCT stop_id) AS unique_stops_served
        FROM silver_schedule s JOIN silver_trips t ON s.trip_id = t.trip_id
        JOIN silver_routes r ON t.route_id = r.route_id GROUP BY r.route_id, route_short_name, route_long_name""",
    "s2_position_landing": "SELECT * EXCLUDE (ingested_at, wall) FROM raw_positions",
    "s3_weather_scan": "SELECT * FROM silver_weather",
    "s4_fuel_seed": "SELECT CAST(date AS VARCHAR) AS date, petrol_delhi_inr, diesel_delhi_inr, source_note FROM fuel",
    "s5_observation_scan": f"""
        {_EXPORT}, bus_number, problem_type, severity, status, CAST(latitude AS VARCHAR) AS latitude,
        CAST(longitude AS VARCHAR) AS longitude, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS observed_at
        FROM observations""",
    "s6_observation_export": f"""
        {_EXPORT} FROM (SELECT * FROM observations WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY
                        ORDER BY created_at DESC, id DESC)""",
    "s_broken_records": "\nUNION ALL ".join(
        f"SELECT '{source}' AS source, count(*) FILTER (NOT ({bad})) AS n_loaded, count(*) FILTER ({bad}) AS n_broken FROM customer"
        for source, bad in (
            ("stops", "c_custkey % 5 = 0 OR c_custkey % 7 = 0"), ("fuel", "c_custkey % 3 = 0"), ("weather", "c_custkey % 4 = 0")
        )
    ),
    "s7_create_or_merge": """
        SELECT CASE WHEN created_at >= TIMESTAMP '2024-01-12' THEN 'RESOLVED' ELSE status END AS status, count(*) AS n
        FROM observations GROUP BY 1""",
    "s8_tables_across_schemas": """
        SELECT t.route_id, count(*) AS trips, any_value(route_long_name) AS route_long_name
        FROM dim_trip t JOIN dim_route r ON t.route_id = r.route_id GROUP BY 1""",
    "l1_star_reload": _LIST_TABLES,
    "l2_incremental_positions": """
        SELECT entity_id, ingested_at, derived_speed_kmh FROM fact_vehicle_positions
        WHERE TRY_CAST(ingested_at AS TIMESTAMP) IS NOT NULL""",
    "l3_full_reload": "SELECT entity_id, ingested_at, derived_speed_kmh FROM fact_vehicle_positions",
    "l4_upsert_observations": """
        SELECT id, CASE WHEN created_at >= TIMESTAMP '2024-01-12' THEN 'RESOLVED' ELSE status END AS status,
               coalesce(route_id, '') AS route_id, coalesce(description, '') AS description
        FROM observations""",
    "l5_realtime_cycle": """
        SELECT entity_id, vehicle_id, "timestamp",
               CASE WHEN kmh <= 120 THEN round(kmh + 1e-9, 3) END AS derived_speed_kmh,
               CAST(hour(wall) AS INT) AS ping_hour FROM speeds""",
    "o3_enrich_as_of": """
        SELECT s.id, 'B' || max_by(k, valid_from) AS bus_number, CAST(max_by(k, valid_from) % 50 AS VARCHAR) AS route_id
        FROM submissions s LEFT JOIN (
          SELECT CAST(o_orderkey % 20 AS VARCHAR) AS qr_token,
                 TIMESTAMP '2024-01-01' + to_hours((o_orderkey // 20) % 720) AS valid_from, max(o_orderkey) AS k
          FROM orders GROUP BY 1, 2) h ON s.qr_token = h.qr_token AND h.valid_from <= s.created_at
        GROUP BY s.id""",
    "o4_filter_and_page": """
        SELECT id, problem_type, route_id FROM observations
        WHERE severity = 'HIGH' AND status = 'NEW' AND created_at >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY
        ORDER BY created_at DESC, id DESC LIMIT 100 OFFSET 30""",
    "o5_status_update": """
        SELECT o.id, coalesce(c.status, o.status) AS status, problem_type FROM observations o LEFT JOIN (
          SELECT id, max_by(status, changed_at) AS status FROM (
            SELECT CASE WHEN event_id % 35 = 0 THEN -1 - event_id ELSE event_id END AS id,
                   ['REVIEWED', 'RESOLVED', 'CLOSED'][(event_id + copy) % 3 + 1] AS status,
                   ts + to_minutes(copy) AS changed_at
            FROM events JOIN copies ON copy = 0 OR event_id % 10 = 0)
          WHERE status <> 'CLOSED' GROUP BY id) c ON o.id = c.id""",
    "o6_by_route": "SELECT route_id, problem_type, severity, n AS count FROM by_route",
    "o7_by_type": "SELECT problem_type, severity, CAST(sum(n) AS BIGINT) AS count FROM window_counts GROUP BY 1, 2",
    "o8_summary": """
        SELECT count(*) AS total_observations, count(*) FILTER (WHERE status = 'NEW') AS new_observations,
               count(*) FILTER (WHERE status = 'REVIEWED') AS reviewed_observations,
               count(*) FILTER (WHERE status = 'RESOLVED') AS resolved_observations,
               count(*) FILTER (WHERE severity = 'HIGH') AS high_priority,
               count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_priority
        FROM observations""",
    "o8_top_problem_types": """
        SELECT problem_type, count(*) AS count FROM observations GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "o9_route_rollup": """
        SELECT route_id, CAST(sum(n) AS BIGINT) AS count FROM window_counts WHERE route_id IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "o9_route_rollup_exact": """
        SELECT route_id, CAST(sum(n) AS BIGINT) AS count FROM window_counts WHERE route_id IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""",
    "o10_type_rollup": "SELECT problem_type, CAST(sum(n) AS BIGINT) AS count FROM window_counts GROUP BY 1",
    "o11_severity_pivot": """
        SELECT CAST(coalesce(sum(n) FILTER (WHERE severity = 'LOW'), 0) AS BIGINT) AS "LOW",
               CAST(coalesce(sum(n) FILTER (WHERE severity = 'MEDIUM'), 0) AS BIGINT) AS "MEDIUM",
               CAST(coalesce(sum(n) FILTER (WHERE severity = 'HIGH'), 0) AS BIGINT) AS "HIGH",
               CAST(coalesce(sum(n) FILTER (WHERE severity = 'CRITICAL'), 0) AS BIGINT) AS "CRITICAL"
        FROM window_counts""",
    "o12_recent": "SELECT id, status FROM observations ORDER BY created_at DESC, id DESC LIMIT 10",
    "o13_registry_load": """
        SELECT id + 1000000 AS id, qr_token, 1 AS is_active FROM qr_codes WHERE NOT is_active""",
    "o14_local_display": """
        SELECT id, strftime(created_at + INTERVAL 330 MINUTE, '%-d %b, %H:%M') AS observed_local,
               replace(problem_type, '_', ' ') AS problem_label FROM observations""",
    "o14_pick_list": """
        SELECT DISTINCT problem_type AS code,
               array_to_string([upper(w[1:1]) || lower(w[2:]) for w in string_split(problem_type, '_')], ' ') AS label
        FROM observations""",
    "q1_speed_bound": _SPEED,
    "q2_gate_on_silver": _zeros("speed bound", "ping outside box", "unique ping"),
    "q2_gate_on_faulty_pings": f"""
        {_SPEED} UNION ALL SELECT 'ping outside box', count(*) FROM events WHERE event_id % 3 = 2
        UNION ALL {_POSITION_KEYS.format(source='fact_vehicle_positions')}""",
    "q2_gate_in_the_write": f"{_SPEED} UNION ALL SELECT 'ping outside box', count(*) FROM events WHERE event_id % 3 = 2",
    "q3_not_null": _NULLS,
    "q3_missing_keys": _MISSING,
    "q4_unique_keys": """
        SELECT 'unique dim_route.route_id' AS "check", count(*) AS violations FROM (
          SELECT route_id FROM raw_routes GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique dim_stop.stop_id', count(*) FROM (
          SELECT stop_id FROM raw_stops GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique dim_trip.trip_id', count(*) FROM (
          SELECT trip_id FROM raw_trips GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique dim_date.date', count(*) FROM (
          SELECT date FROM holidays GROUP BY 1 HAVING count(*) > 1)""",
    "q5_orphans": _ORPHANS,
    "q6_position_rules": """
        SELECT 'ping outside box' AS "check", (SELECT count(*) FROM raw_positions) - (SELECT count(*) FROM inside)
          AS violations
        UNION ALL """ + _POSITION_KEYS.format(source="raw_positions"),
    "q7_domains": f"""
        {_LENGTHS}
        UNION ALL SELECT 'domain problem_type', count(*) FROM submissions WHERE id % 17 = 16
        UNION ALL SELECT 'domain severity', 0
        UNION ALL SELECT 'domain status', count(*) FROM submissions
        UNION ALL SELECT 'length observations.description', count(*) FROM submissions WHERE id % 89 = 0""",
    "q7_overlong_texts": f"""
        {_READ_LENGTHS} UNION ALL {_OVERLONG}
        UNION ALL SELECT 'domain problem_type', count(*) FROM submissions WHERE id % 17 = 16
        UNION ALL SELECT 'domain severity', count(*) FROM submissions WHERE id % 4 = 3
        UNION ALL SELECT 'domain status', count(*) FROM submissions WHERE id % 3 = 0
        UNION ALL SELECT 'length observations.description', count(*) FROM submissions WHERE id % 89 = 0""",
    "q8_calendar_cover": _CALENDAR.format(cal="holidays"),
    "q_all": f"""
        {_SPEED} UNION ALL {_NULLS} UNION ALL {_KEYS_UNIQUE} UNION ALL {_ORPHANS}
        UNION ALL SELECT 'ping outside box', 0
        UNION ALL {_POSITION_KEYS.format(source='fact_vehicle_positions')}
        UNION ALL {_LENGTHS}
        UNION ALL {_zeros('domain problem_type', 'domain severity', 'domain status', 'length observations.description')}
        UNION ALL {_CALENDAR.format(cal='dim_date')}""",
    "a1_busiest_morning_routes": """
        SELECT route_id, coalesce(route_short_name, route_long_name) AS route_name, count(*) AS morning_stop_events
        FROM served WHERE departure_hour BETWEEN 7 AND 9 GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20""",
    "a2_rain_and_stoppage": f"""
        SELECT is_rainy_day, count(*) AS days, {_avg('pct_stopped')}, round(avg(avg_speed_kmh) + 1e-9, 6) AS avg_speed_kmh
        FROM impact WHERE total_pings > 0 GROUP BY 1""",
    "a2_rain_correlation": """
        SELECT round(corr(precipitation_mm, pct_stopped) + 1e-9, 6) AS rain_stop_corr FROM impact WHERE total_pings > 0""",
    "a3_peak_split": """
        SELECT CAST(sum(peak_hour_stops) AS BIGINT) AS peak_hour_stops,
               CAST(sum(offpeak_stops) AS BIGINT) AS offpeak_stops FROM route_summary""",
    "a4_route_coverage": """
        SELECT route_id, route_name, unique_stops_served,
               rank() OVER (ORDER BY unique_stops_served DESC) AS coverage_rank FROM route_summary""",
    "a5_fuel_baseline": """
        SELECT CAST(date AS VARCHAR) AS date, round(petrol_delhi_inr + 1e-9, 6) AS petrol_delhi_inr,
               round(diesel_delhi_inr + 1e-9, 6) AS diesel_delhi_inr,
               round(petrol_delhi_inr / first_value(petrol_delhi_inr) OVER w + 1e-9, 6) AS petrol_ratio,
               round(diesel_delhi_inr / first_value(diesel_delhi_inr) OVER w + 1e-9, 6) AS diesel_ratio
        FROM fuel WINDOW w AS (ORDER BY date)""",
}

ORACLES: dict[str, str] = {name: _with_inputs(sql) for name, sql in _STATEMENTS.items()}
ORACLES["o1_classify"] = _with_inputs(
    """SELECT s.id, coalesce(s.verdict, CASE WHEN k.id IS NOT NULL THEN 'accepted' ELSE 'duplicate' END) AS verdict
       FROM screened s LEFT JOIN kept k ON s.id = k.id""",
    _PENDING + _spaced("pending"),
)
ORACLES["o2_stream_intake"] = ORACLES["o1_classify"]
ORACLES["o2_stream_out_of_order"] = ORACLES["o1_classify"]
ORACLES["l1_access_reload"] = ORACLES["m4_rls_access_table"]
ORACLES["l5_late_cycle"] = ORACLES["l5_realtime_cycle"]
ORACLES["g4_from_stored_silver"] = ORACLES["g4_vehicle_activity"]
ORACLES["g6_from_stored_silver"] = ORACLES["g6_weather_vs_activity"]
ORACLES["o2_greedy_dedupe"] = _with_inputs(
    "SELECT id, qr_code_id, anonymous_identifier FROM kept", _KEYED + _spaced("keyed")
)
ORACLES["o3_enrich"] = _with_inputs(
    """SELECT s.id, s.qr_code_id, s.bus_number, s.route_id, 'NEW' AS status FROM screened s JOIN kept k ON s.id = k.id""",
    _PENDING + _spaced("pending"),
)
ORACLES["g4_kept_up_to_date"] = ORACLES["g4_vehicle_activity"]
ORACLES["g6_kept_up_to_date"] = ORACLES["g6_weather_vs_activity"]
