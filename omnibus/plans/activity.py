"""Activity views kept up to date from partial aggregates of the pings.

The partials have one row per route, vehicle, hour and day.  All their columns
add up, and a vehicle stands once in each group, so distinct vehicles are rows
counted.  They are partitioned by day.  A load names the days it will touch
before it begins, and afterwards the partials of those days alone are made anew
from the pings and switched at once; so late and corrected pings, replays and
loads that broke off on the way leave no trace.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus import params
from omnibus.functions import measures
from omnibus.plans import gold, loads
from omnibus.sources import tables, versioned

PARTIALS = "vehicle_activity_partials"
DAY = ("ping_date",)
_TOUCHED = "days_to_refresh"


def partials(positions: DataFrame) -> DataFrame:
    speed = F.col("derived_speed_kmh")
    moving = measures.moving_speed(speed)
    return positions.groupBy("route_id", "vehicle_id", "ping_hour", "ping_date").agg(
        F.count("*").alias("pings"),
        F.sum(F.when(measures.is_stopped(speed), 1).otherwise(0)).alias("stopped"),
        F.count(moving).alias("speeds"),
        F.sum(moving).alias("speed_sum"),
    )


def touch(spark: SparkSession, schema: str, days: set[versioned.Part]) -> None:
    """Note the days that a load is about to change."""
    name = f"{schema}.{PARTIALS}"
    if tables.exists(spark, name) and days:
        noted = _noted(spark, name) | days
        tables.set_mark(spark, name, _TOUCHED, json.dumps(sorted(noted, key=str)))


def refresh(spark: SparkSession, schema: str, root: str) -> None:
    """Bring the partials of all noted days up to the stored pings; all days where there are no partials yet."""
    name = f"{schema}.{PARTIALS}"
    pings = tables.read(spark, f"{schema}.{loads.POSITIONS}")
    if not tables.exists(spark, name):
        versioned.publish(partials(pings), name, root, DAY)
        return
    days = _noted(spark, name)
    touched = pings.where(tables.on_days("ping_date", {d for (d,) in days}))
    versioned.replace(partials(touched), name, days)
    tables.set_mark(spark, name, _TOUCHED, "[]")


def _noted(spark: SparkSession, name: str) -> set[versioned.Part]:
    return {tuple(d) for d in json.loads(tables.mark_of(spark, name, _TOUCHED) or "[]")}


def _speed_measures() -> list:
    speed = F.try_divide(F.sum("speed_sum"), F.sum("speeds"))
    return [speed.alias("speed"), F.sum("stopped").alias("stopped"), F.sum("pings").alias("rows")]


def vehicle_activity(kept: DataFrame, routes: DataFrame, cutoff: dt.date = params.ACTIVITY_CUTOFF) -> DataFrame:
    """``gold.vehicle_activity`` from the partials."""
    per_hour = (
        kept.where(F.col("ping_date") >= F.lit(cutoff))
        .groupBy("route_id", F.col("ping_hour").alias("activity_hour"), F.col("ping_date").alias("activity_date"))
        .agg(F.count("vehicle_id").alias("unique_vehicles"), *_speed_measures())
    )
    return gold.named_activity(per_hour, routes)


def weather_vs_activity(weather: DataFrame, kept: DataFrame) -> DataFrame:
    """``gold.weather_vs_activity`` from the partials."""
    per_day = kept.groupBy(F.col("ping_date").alias("date")).agg(
        F.coalesce(F.sum(F.when(F.col("vehicle_id").isNotNull(), F.col("pings"))), F.lit(0)).alias("pings"),
        F.count_distinct("vehicle_id").alias("buses"),
        *_speed_measures(),
    )
    return gold.weather_days(weather, per_day)
