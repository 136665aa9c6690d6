"""Transit-shaped inputs derived from the test tables.

The test data has no transit tables.  Each view here maps one test table onto
one input of the library with integer arithmetic and text functions only, so
that another engine can derive the very same rows.  Averaged columns lie on a
quarter grid, which keeps sums exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.params import PROBLEM_TYPES, WEEKDAYS
from omnibus.plans import silver
from omnibus.plans.views import Views

_REPEAT = "explode(sequence(0, if({}, 1, 0))) AS copy"


def _codes(values, index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} AS int) + 1)"


class Analogs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- landed schedule files -------------------------------------------------

    def gtfs(self) -> dict[str, DataFrame]:
        return {
            "routes": self.routes(), "stops": self.stops(), "trips": self.trips(),
            "stop_times": self.stop_times(), "calendar": self.calendar(), "agency": self.agency(),
        }

    def routes(self) -> DataFrame:
        """Every 29th route twice; some types are not numbers."""
        return self.table("customer").selectExpr(
            "*", _REPEAT.format("c_custkey % 29 = 0")
        ).selectExpr(
            "cast(c_custkey AS string) AS route_id",
            "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' "
            "ELSE concat('R', c_custkey) END AS route_short_name",
            "c_name AS route_long_name",
            "if(c_custkey % 41 = 0, 'bus', '3') AS route_type",
        )

    def stops(self) -> DataFrame:
        """Every 31st latitude is empty."""
        return self.table("part").selectExpr(
            "cast(p_partkey AS string) AS stop_id",
            "p_name AS stop_name",
            "if(p_partkey % 31 = 0, '', concat('28.', 400 + p_partkey % 500)) AS stop_lat",
            "concat((76800 + p_partkey % 700) div 1000, '.', lpad((76800 + p_partkey % 700) % 1000, 3, '0')) AS stop_lon",
        )

    def trips(self) -> DataFrame:
        """Every 19th trip runs under a service the calendar does not hold."""
        return self.table("orders").selectExpr(
            "cast(o_orderkey AS string) AS trip_id",
            "cast(o_custkey AS string) AS route_id",
            "if(o_orderkey % 19 = 0, 'none', o_orderpriority) AS service_id",
            "concat('S', o_orderkey % 97) AS shape_id",
        )

    def calendar(self) -> DataFrame:
        services = self.table("orders").groupBy("o_orderpriority").agg(F.max("o_orderkey").alias("k"))
        flags = [f"cast((k >> {i}) & 1 AS string) AS {d}" for i, d in enumerate(WEEKDAYS)]
        return services.selectExpr(
            "o_orderpriority AS service_id", *flags, "'20240101' AS start_date", "'20261231' AS end_date"
        )

    def stop_times(self) -> DataFrame:
        """Times run past 24 hours; some are empty or junk."""
        time = (
            "CASE WHEN l_partkey % 101 = 0 THEN '' WHEN l_partkey % 103 = 0 THEN 'soon' "
            "ELSE concat(lpad((l_orderkey * 7 + l_linenumber) % 27, 2, '0'), ':', "
            "lpad(l_suppkey % 60, 2, '0'), ':00') END"
        )
        return self.table("lineitem").selectExpr(
            "cast(l_orderkey AS string) AS trip_id",
            "cast(l_partkey AS string) AS stop_id",
            "cast(l_linenumber AS string) AS stop_sequence",
            f"{time} AS arrival_time",
            f"{time} AS departure_time",
        )

    def agency(self) -> DataFrame:
        return self.table("region").selectExpr(
            "cast(r_regionkey AS string) AS agency_id", "r_name AS agency_name",
            "'' AS agency_url", "'Asia/Kolkata' AS agency_timezone",
        )

    # --- star tables -------------------------------------------------------------

    def dim_route(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey AS string) AS route_id",
            "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' "
            "ELSE concat('R', c_custkey) END AS route_short_name",
            "if(c_custkey % 53 = 0, NULL, c_name) AS route_long_name",
            "3 AS route_type",
        )

    def dim_stop(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey AS string) AS stop_id", "p_name AS stop_name",
            "28.4D + (p_partkey % 500) / 1000D AS stop_lat", "76.8D + (p_partkey % 700) / 1000D AS stop_lon",
        )

    def dim_trip(self) -> DataFrame:
        flags = [f"cast((o_orderkey >> {i}) & 1 AS int) AS {d}" for i, d in enumerate(WEEKDAYS)]
        return self.table("orders").selectExpr(
            "cast(o_orderkey AS string) AS trip_id",
            "if(o_orderkey % 59 = 0, NULL, cast(o_custkey AS string)) AS route_id",
            "o_orderpriority AS service_id", "concat('S', o_orderkey % 97) AS shape_id",
            *flags, "'20240101' AS start_date", "'20261231' AS end_date",
        )

    def dim_date(self) -> DataFrame:
        """One row per day that any fact uses."""
        return silver.dim_date(self.date_bounds(), self.holidays())

    def date_bounds(self) -> DataFrame:
        """First and last day over pings, weather and orders."""
        pings = self.table("events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
        orders = self.table("orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
        weather = self.weather().agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        days = [df.select(F.to_date("lo").alias("lo"), F.to_date("hi").alias("hi")) for df in (pings, orders, weather)]
        return days[0].unionByName(days[1]).unionByName(days[2]).agg(
            F.min("lo").alias("start"), F.max("hi").alias("end")
        )

    def holidays(self) -> DataFrame:
        """Days with a very large order, one row per such order."""
        return self.table("orders").where("o_totalprice > 440000").selectExpr("cast(o_orderdate AS date) AS date")

    def fact_schedule(self) -> DataFrame:
        """Some trips are unknown; some hours and flags are NULL."""
        hour = "cast(if(l_partkey % 101 = 0, NULL, (l_orderkey * 7 + l_linenumber) % 27) AS int)"
        return self.table("lineitem").selectExpr(
            "*", f"{hour} AS h", "cast(l_suppkey % 60 AS int) AS m"
        ).selectExpr(
            "*", "concat(lpad(h, 2, '0'), ':', lpad(m, 2, '0'), ':00') AS t", "h * 3600 + m * 60 AS secs"
        ).selectExpr(
            "if(l_partkey % 43 = 0, concat('X', l_orderkey), cast(l_orderkey AS string)) AS trip_id",
            "cast(l_partkey AS string) AS stop_id",
            "l_linenumber AS stop_sequence", "t AS arrival_time", "t AS departure_time",
            "secs AS arrival_secs", "secs AS departure_secs", "h AS departure_hour",
            "CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN h BETWEEN 7 AND 9 OR h BETWEEN 17 AND 19 "
            "THEN 1 ELSE 0 END AS is_peak_hour",
        )

    def fact_vehicle_positions(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat('E', event_id) AS entity_id",
            "cast(user_id AS string) AS vehicle_id",
            "cast(event_id % 1000 AS string) AS trip_id",
            "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'unknown' "
            "ELSE cast(user_id AS string) END AS route_id",
            "28.4D + (event_id * 37 % 500) / 1000D AS latitude",
            "76.8D + (event_id * 53 % 700) / 1000D AS longitude",
            "CASE WHEN event_id % 10 = 0 THEN 0.0D ELSE floor(value * 4) / 4D END AS speed",
            "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+05:30') AS timestamp",
            "cast(event_id % 3 AS int) AS status",
            "if(event_id % 47 = 0, 'late', date_format(ts, \"yyyy-MM-dd'T'HH:mm:00\")) AS ingested_at",
            "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 2.0D "
            "ELSE floor(value * 4) / 4D END AS derived_speed_kmh",
        )

    def weather(self) -> DataFrame:
        days = self.table("orders").selectExpr(
            "date_add(date'2024-01-01', cast(o_orderkey % 45 AS int)) AS date", "o_custkey"
        ).groupBy("date").agg(F.max("o_custkey").alias("k"))
        return days.selectExpr(
            "date",
            "(25 + k % 17) / 1D AS temp_max_c", "(15 + k % 17) / 1D AS temp_min_c",
            "(20 + k % 17) / 2D AS temp_avg_c", "(k % 40) / 4D AS precipitation_mm",
            "(k % 50) / 1D AS windspeed_max_kmh", "cast(k % 100 AS int) AS weather_code",
            "CASE k % 3 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Drizzle/Rain' END AS weather_label",
            "cast(if(k % 3 = 1, 1, 0) AS int) AS is_rainy_day",
        )

    def fuel(self) -> DataFrame:
        months = self.table("orders").selectExpr(
            "cast(trunc(cast(o_orderdate AS date), 'MM') AS date) AS date", "o_orderkey"
        ).groupBy("date").agg(F.max("o_orderkey").alias("hi"), F.min("o_orderkey").alias("lo"))
        return months.selectExpr(
            "date", "90D + (hi % 40) / 4D AS petrol_delhi_inr", "80D + (lo % 40) / 4D AS diesel_delhi_inr",
            "'seed' AS source_note",
        )

    def user_route_access(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "concat('user', c_nationkey) AS user_email", "cast(c_custkey AS string) AS route_id"
        )

    def star(self) -> Views:
        return Views({
            "dim_route": self.dim_route, "dim_stop": self.dim_stop, "dim_trip": self.dim_trip,
            "dim_date": self.dim_date, "fact_schedule": self.fact_schedule,
            "fact_vehicle_positions": self.fact_vehicle_positions,
            "fact_weather_daily": self.weather, "fact_fuel_prices": self.fuel,
            "user_route_access": self.user_route_access,
        })

    def faulty_star(self) -> Views:
        """The star tables with missing keys, overlong texts, and pings outside the box."""
        star = self.star()

        def changed(table: str, **columns: str):
            return lambda: star[table].withColumns({c: F.expr(e) for c, e in columns.items()})

        every = "if(cast({c} AS bigint) % {n} = 0, {bad}, {c})"
        missing = lambda c, n: every.format(c=c, n=n, bad="NULL")
        return Views({
            **{name: lambda n=name: star[n] for name in ("fact_weather_daily", "fact_fuel_prices")},
            "dim_route": changed("dim_route", route_id=missing("route_id", 61)),
            "dim_stop": changed("dim_stop", stop_id=missing("stop_id", 67)),
            "dim_trip": changed(
                "dim_trip", trip_id=missing("trip_id", 71),
                start_date="if(cast(trip_id AS bigint) % 37 = 0, repeat('2', 21), start_date)",
                end_date="if(cast(trip_id AS bigint) % 41 = 0, repeat('2', 21), end_date)",
            ),
            "dim_date": changed(
                "dim_date", date_key="if(day_of_month = 13, NULL, date_key)",
                month_name="if(month = 2, repeat('m', 21), month_name)",
                day_name="if(day_of_month = 7, repeat('d', 21), day_name)",
            ),
            "fact_schedule": changed(
                "fact_schedule", arrival_time="if(stop_sequence = 3, concat(arrival_time, ':00'), arrival_time)",
                departure_time="if(stop_sequence = 5, concat(departure_time, ':00'), departure_time)",
            ),
            "fact_vehicle_positions": changed(
                "fact_vehicle_positions", trip_id="if(status = 1, repeat('t', 101), trip_id)",
                latitude="if(status = 2, 0D, latitude)",
            ),
            "user_route_access": changed(
                "user_route_access", user_email="if(cast(route_id AS bigint) % 73 = 0, NULL, user_email)",
                route_id=missing("route_id", 79),
            ),
        })

    # --- realtime feed -----------------------------------------------------------

    def raw_positions(self) -> DataFrame:
        """Glitches at (0, 0), missing coordinates, and a later copy of every 29th ping."""
        glitch = "event_id % 23 = 0"
        gap = "event_id % 31 = 0"
        return self.table("events").selectExpr("*", _REPEAT.format("event_id % 29 = 0")).selectExpr(
            "concat('E', event_id, if(copy = 1, 'b', '')) AS entity_id",
            "cast(user_id AS string) AS vehicle_id",
            "cast(event_id % 1000 AS string) AS trip_id",
            "cast(user_id % 50 AS string) AS route_id",
            f"CASE WHEN {glitch} THEN 0D WHEN {gap} THEN NULL ELSE 28.4D + (event_id * 37 % 500) / 1000D END AS latitude",
            f"CASE WHEN {glitch} THEN 0D WHEN {gap} THEN NULL ELSE 76.8D + (event_id * 53 % 700) / 1000D END AS longitude",
            "floor(value * 4) / 4D AS speed",
            "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+05:30') AS timestamp",
            "cast(event_id % 3 AS int) AS status",
            "if(event_id % 47 = 0, 'late', date_format(ts + make_dt_interval(0, 0, copy), "
            "\"yyyy-MM-dd'T'HH:mm:00\")) AS ingested_at",
        )

    # --- field observations --------------------------------------------------------

    def qr_codes(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS id",
            "cast(s_suppkey AS string) AS qr_token",
            "concat('B', s_suppkey) AS bus_number",
            "if(s_suppkey % 9 = 0, NULL, cast(s_suppkey % 30 AS string)) AS route_id",
            "concat('Depot ', s_nationkey) AS location",
            "s_suppkey % 10 <> 0 AS is_active",
            "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(s_suppkey % 1000 AS int)) AS created_at",
        )

    def submissions(self) -> DataFrame:
        """Few tokens and identifiers, so that repeats within the hour are common."""
        return self.table("events").selectExpr(
            "event_id AS id",
            "if(event_id % 97 = 0, '', cast(user_id % 20 AS string)) AS qr_token",
            _codes([*PROBLEM_TYPES, "LOST_ITEM"], "event_id % 17") + " AS problem_type",
            _codes(["LOW", "MEDIUM", "HIGH", "CRITICAL"], "event_id % 4") + " AS severity",
            "if(event_id % 89 = 0, repeat('x', 1001), concat('note ', event_id)) AS description",
            "if(event_id % 79 = 0, NULL, cast(ts AS timestamp)) AS observed_at",
            "if(event_id % 83 = 0, 95D, 28.4D + (event_id * 37 % 500) / 1000D) AS latitude",
            "76.8D + (event_id * 53 % 700) / 1000D AS longitude",
            "if(event_id % 101 = 0, '', concat('anon', user_id % 5)) AS anonymous_identifier",
            "cast(ts AS timestamp) AS created_at",
        )

    def observations(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS id",
            "cast(user_id % 20 AS int) AS qr_code_id",
            "concat('B', user_id % 20) AS bus_number",
            "if(event_id % 11 = 0, NULL, cast(user_id % 50 AS string)) AS route_id",
            _codes(PROBLEM_TYPES, "event_id * 7 % 16") + " AS problem_type",
            _codes(["LOW", "MEDIUM", "HIGH", "CRITICAL"], "event_id * 3 % 5 % 4") + " AS severity",
            "if(event_id % 6 = 0, NULL, concat('said \"hi\", line\\n', event_id)) AS description",
            "cast(ts AS timestamp) AS observed_at",
            "28.4D + (event_id * 37 % 500) / 1000D AS latitude",
            "76.8D + (event_id * 53 % 700) / 1000D AS longitude",
            _codes(["NEW", "REVIEWED", "RESOLVED"], "event_id % 3") + " AS status",
            "cast(ts AS timestamp) AS created_at",
        )

    def status_changes(self) -> DataFrame:
        """Two changes for some ids, ids that do not exist, and a bad status."""
        return self.table("events").selectExpr(
            "*", _REPEAT.format("event_id % 10 = 0")
        ).selectExpr(
            "if(event_id % 35 = 0, -1 - event_id, event_id) AS id",
            _codes(["REVIEWED", "RESOLVED", "CLOSED"], "(event_id + copy) % 3") + " AS status",
            "cast(ts AS timestamp) + make_dt_interval(0, 0, copy) AS changed_at",
        )

    def assignments(self) -> DataFrame:
        """Bus and route of a token over time."""
        return self.table("orders").selectExpr(
            "cast(o_orderkey % 20 AS string) AS qr_token",
            "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast((o_orderkey div 20) % 720 AS int)) AS valid_from",
            "o_orderkey",
        ).groupBy("qr_token", "valid_from").agg(F.max("o_orderkey").alias("k")).selectExpr(
            "qr_token", "valid_from", "concat('B', k) AS bus_number", "cast(k % 50 AS string) AS route_id"
        )
