"""The documented questions that have no view of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnibus.operators.ranking import rank_by_value


def busiest_morning_routes(schedule: DataFrame, trips: DataFrame, routes: DataFrame, top: int = 20) -> DataFrame:
    """Routes with most stop events in hours 7 to 9."""
    morning = schedule.where(F.col("departure_hour").between(7, 9)).select("trip_id")
    counts = (
        morning.join(trips.select("trip_id", "route_id"), "trip_id")
        .groupBy("route_id")
        .agg(F.count("*").alias("events"))
    )
    return (
        counts.join(routes.select("route_id", "route_short_name", "route_long_name"), "route_id")
        .groupBy("route_id", F.coalesce("route_short_name", "route_long_name").alias("route_name"))
        .agg(F.sum("events").alias("morning_stop_events"))
        .orderBy(F.desc("morning_stop_events"), "route_id")
        .limit(top)
    )


def rain_and_stoppage(weather_activity: DataFrame) -> DataFrame:
    """Average stopped share on dry and rainy days that had pings."""
    return (
        weather_activity.where("total_pings > 0")
        .groupBy("is_rainy_day")
        .agg(
            F.count("*").alias("days"),
            F.avg("pct_stopped").alias("avg_pct_stopped"),
            F.avg("avg_speed_kmh").alias("avg_speed_kmh"),
        )
    )


def rain_correlation(weather_activity: DataFrame) -> DataFrame:
    return weather_activity.where("total_pings > 0").agg(
        F.corr("precipitation_mm", "pct_stopped").alias("rain_stop_corr")
    )


def peak_split(route_summary: DataFrame) -> DataFrame:
    return route_summary.agg(
        F.sum("peak_hour_stops").alias("peak_hour_stops"), F.sum("offpeak_stops").alias("offpeak_stops")
    )


def route_coverage(route_summary: DataFrame) -> DataFrame:
    """Routes ranked by the number of different stops they serve."""
    served = route_summary.select("route_id", "route_name", "unique_stops_served")
    return rank_by_value(served, "unique_stops_served", "coverage_rank")


def fuel_against_baseline(fuel: DataFrame) -> DataFrame:
    """Prices relative to the first date's prices."""
    first = fuel.where(F.col("date").isNotNull())
    base = lambda c: first.agg(F.min_by(c, "date")).scalar()
    return fuel.select(
        "date",
        "petrol_delhi_inr",
        "diesel_delhi_inr",
        (F.col("petrol_delhi_inr") / base("petrol_delhi_inr")).alias("petrol_ratio"),
        (F.col("diesel_delhi_inr") / base("diesel_delhi_inr")).alias("diesel_ratio"),
    )
