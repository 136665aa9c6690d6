"""The six gold views and the report measure.

Facts are aggregated by their key before dimension names are joined on, so the
joins see one row per group instead of the fact.  A dimension key that occurs
more than once multiplies counts, exactly as a plain join would; the ``copies``
factor carries that through the early aggregation.

Exact distinct counts need no salting: Spark first groups by (key, distinct
value), which spreads a hot key, and shuffles one row per task for the rest.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus import params
from omnibus.functions import clock, measures
from omnibus.plans.views import Views

STAR_TABLES = (
    "dim_route", "dim_stop", "dim_trip", "dim_date", "fact_schedule", "fact_vehicle_positions",
    "fact_weather_daily", "fact_fuel_prices", "user_route_access",
)

GOLD_VIEWS = (
    "route_schedule_summary", "top_routes", "hourly_distribution", "vehicle_activity",
    "weather_summary", "weather_vs_activity",
)


def _served(schedule: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Stop events per route, with names and copies of the route row.

    Events shrink to one row per trip before they meet the trips, so trips are
    counted as rows; stops are counted from distinct (trip, stop) pairs.
    """
    flag = F.col("is_peak_hour")
    assigned = trips.groupBy("trip_id", "route_id").agg(F.count("*").alias("_n"))
    per_trip = schedule.groupBy("trip_id").agg(
        F.count("*").alias("events"),
        F.count("stop_id").alias("stop_events"),
        F.sum(flag).alias("peak"),
        F.sum(F.when(flag == 0, 1).otherwise(0)).alias("offpeak"),
    )
    totals = ("events", "stop_events", "peak", "offpeak")
    per_route = (
        per_trip.join(assigned, "trip_id")
        .groupBy("route_id")
        .agg(F.count("*").alias("trips"), *[F.sum(F.col(c) * F.col("_n")).alias(c) for c in totals])
    )
    visited = schedule.select("trip_id", "stop_id").distinct().join(assigned.select("trip_id", "route_id"), "trip_id")
    stops = visited.select("route_id", "stop_id").distinct().groupBy("route_id").agg(F.count("stop_id").alias("stops"))
    named = routes.groupBy("route_id", "route_short_name", "route_long_name").agg(
        F.count("*").alias("copies")
    )
    return per_route.join(stops, "route_id").join(named, "route_id").withColumn(
        "route_name", F.coalesce("route_short_name", "route_long_name")
    )


def route_schedule_summary(schedule: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    one_decimal = "decimal(5,1)"
    share = measures.percent(F.col("peak"), F.col("events")).cast(one_decimal)
    n = F.col("copies")
    return _served(schedule, trips, routes).select(
        "route_id",
        "route_name",
        F.col("trips").alias("total_trips"),
        (F.col("events") * n).alias("total_stop_events"),
        (F.col("peak") * n).alias("peak_hour_stops"),
        (F.col("offpeak") * n).alias("offpeak_stops"),
        F.round(share, 1).cast(one_decimal).alias("peak_hour_pct"),
        F.col("stops").alias("unique_stops_served"),
    )


def top_routes(
    schedule: DataFrame, trips: DataFrame, routes: DataFrame, limit: int = params.TOP_ROUTES
) -> DataFrame:
    """The routes with most trips; route_id settles ties."""
    n = F.col("copies")
    return (
        _served(schedule, trips, routes)
        .select(
            "route_id",
            "route_name",
            F.col("trips").alias("scheduled_trips"),
            (F.col("stop_events") * n).alias("total_stop_events"),
            F.col("stops").alias("unique_stops"),
            (F.col("peak") * n).alias("peak_events"),
        )
        .orderBy(F.desc("scheduled_trips"), "route_id")
        .limit(limit)
    )


def hourly_distribution(schedule: DataFrame) -> DataFrame:
    return (
        schedule.groupBy(F.col("departure_hour").alias("hour_of_day"))
        .agg(
            F.count("*").alias("total_departures"),
            F.count_distinct("trip_id").alias("unique_trips"),
            F.sum("is_peak_hour").alias("is_peak_hour"),
        )
        .withColumn("time_slot", clock.time_slot(F.col("hour_of_day")))
    )


def _ping_date(positions: DataFrame) -> Column:
    """The stored date where silver has one (prunes partitions), else derived."""
    return F.col("ping_date") if "ping_date" in positions.columns else clock.wall_date(F.col("timestamp"))


def _ping_hour(positions: DataFrame) -> Column:
    return F.col("ping_hour") if "ping_hour" in positions.columns else clock.wall_hour(F.col("timestamp"))


def _speed_measures() -> list[Column]:
    speed = F.col("derived_speed_kmh")
    return [
        F.avg(measures.moving_speed(speed)).alias("speed"),
        F.sum(F.when(measures.is_stopped(speed), 1).otherwise(0)).alias("stopped"),
        F.count("*").alias("rows"),
    ]


def vehicle_activity(
    positions: DataFrame, routes: DataFrame, cutoff: dt.date = params.ACTIVITY_CUTOFF
) -> DataFrame:
    day, hour = _ping_date(positions), _ping_hour(positions)
    per_hour = (
        positions.where(day >= F.lit(cutoff))
        .groupBy("route_id", hour.alias("activity_hour"), day.alias("activity_date"))
        .agg(F.count_distinct("vehicle_id").alias("unique_vehicles"), *_speed_measures())
    )
    return named_activity(per_hour, routes)


def named_activity(per_hour: DataFrame, routes: DataFrame) -> DataFrame:
    """The activity view from one row per route, hour and day."""
    named = routes.groupBy("route_id", "route_long_name").agg(F.count("*").alias("copies"))
    n = F.coalesce("copies", F.lit(1))
    return (
        per_hour.join(named, "route_id", "left")
        .select(
            "route_id",
            F.col("route_long_name").alias("route_name"),
            "activity_hour",
            "activity_date",
            (F.col("rows") * n).alias("position_pings"),
            "unique_vehicles",
            F.round("speed", 2).alias("avg_speed_kmh"),
            (F.col("stopped") * n).alias("stopped_pings"),
            F.round(measures.percent(F.col("stopped"), F.col("rows")), 1).cast("double").alias("pct_stopped"),
        )
    )


def weather_summary(weather: DataFrame) -> DataFrame:
    return weather.groupBy("weather_label").agg(
        F.count("*").alias("total_days"),
        F.round(F.avg("temp_avg_c"), 1).alias("avg_temp_c"),
        F.round(F.avg("precipitation_mm"), 2).alias("avg_rain_mm"),
        F.round(F.max("precipitation_mm"), 2).alias("max_rain_mm"),
        F.round(F.avg("windspeed_max_kmh"), 1).alias("avg_wind_kmh"),
        F.sum("is_rainy_day").alias("rainy_days"),
    )


def weather_vs_activity(weather: DataFrame, positions: DataFrame) -> DataFrame:
    """Weather days with the pings of that day; days without pings stay.

    A day without pings counts as one padded row, so its stopped share is 0.
    """
    per_day = positions.groupBy(_ping_date(positions).alias("date")).agg(
        F.count("vehicle_id").alias("pings"),
        F.count_distinct("vehicle_id").alias("buses"),
        *_speed_measures(),
    )
    return weather_days(weather, per_day)


def weather_days(weather: DataFrame, per_day: DataFrame) -> DataFrame:
    """The weather view from one row of pings per day."""
    days = weather.groupBy(
        "date", "weather_label", "is_rainy_day", "precipitation_mm", "temp_avg_c"
    ).agg(F.count("*").alias("copies"))
    n, zero = F.col("copies"), F.lit(0)
    stopped = F.coalesce("stopped", zero)
    return days.join(per_day, "date", "left").select(
        "date",
        "weather_label",
        "is_rainy_day",
        "precipitation_mm",
        "temp_avg_c",
        (F.coalesce("pings", zero) * n).alias("total_pings"),
        F.coalesce("buses", zero).alias("active_buses"),
        F.round("speed", 2).alias("avg_speed_kmh"),
        (stopped * n).alias("stopped_pings"),
        F.round(measures.percent(stopped, F.coalesce("rows", F.lit(1))), 1)
        .cast("double")
        .alias("pct_stopped"),
    )


def not_stopped_pings() -> Column:
    """The model's measure: all pings less the stopped ones."""
    return F.sum("position_pings") - F.sum("stopped_pings")


def build_model(tables: dict[str, DataFrame], cutoff: dt.date = params.ACTIVITY_CUTOFF) -> Views:
    """The star tables and the gold views over them; each is planned when asked for."""

    def network():
        return tables["fact_schedule"], tables["dim_trip"], tables["dim_route"]

    views = {
        "route_schedule_summary": lambda: route_schedule_summary(*network()),
        "top_routes": lambda: top_routes(*network()),
        "hourly_distribution": lambda: hourly_distribution(tables["fact_schedule"]),
        "vehicle_activity": lambda: vehicle_activity(
            tables["fact_vehicle_positions"], tables["dim_route"], cutoff
        ),
        "weather_summary": lambda: weather_summary(tables["fact_weather_daily"]),
        "weather_vs_activity": lambda: weather_vs_activity(
            tables["fact_weather_daily"], tables["fact_vehicle_positions"]
        ),
    }

    # Filters on routes go below these views' aggregates: they group by route.
    # TopRoutes picks its routes before any filter, so it is not one of them.
    def summary_of(keys: DataFrame) -> DataFrame:
        trips = tables["dim_trip"].join(keys, "route_id", "left_semi")
        return route_schedule_summary(tables["fact_schedule"], trips, tables["dim_route"])

    def activity_of(keys: DataFrame) -> DataFrame:
        pings = tables["fact_vehicle_positions"].join(keys, "route_id", "left_semi")
        return vehicle_activity(pings, tables["dim_route"], cutoff)

    by_route = {"route_schedule_summary": summary_of, "vehicle_activity": activity_of}
    return Views({**{name: partial(tables.__getitem__, name) for name in STAR_TABLES}, **views}, by_route=by_route)
