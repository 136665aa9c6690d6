"""Bronze to silver: cleaned, typed and feature-bearing tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus import params
from omnibus.functions import clock, geo, measures
from omnibus.operators.asof import last_before
from omnibus.operators.dedupe import keep_first
from omnibus.schemas import BRONZE_POSITIONS, FACT_POSITIONS, names


def dim_route(routes: DataFrame) -> DataFrame:
    typed = routes.select(
        "route_id", "route_short_name", "route_long_name",
        F.col("route_type").try_cast("int").alias("route_type"),
    )
    return keep_first(typed, ["route_id"])


def dim_stop(stops: DataFrame) -> DataFrame:
    typed = stops.select(
        "stop_id", "stop_name",
        F.col("stop_lat").try_cast("double").alias("stop_lat"),
        F.col("stop_lon").try_cast("double").alias("stop_lon"),
    )
    return keep_first(typed, ["stop_id"])


def dim_trip(trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips with the day flags of their service; unknown services give NULL flags.

    A service that is listed twice counts once and multiplies no trips.  A trip
    listed twice stays twice, so that the gate can stop the load for it.
    """
    service = keep_first(calendar.select(
        "service_id",
        *[F.col(d).try_cast("int").alias(d) for d in params.WEEKDAYS],
        "start_date", "end_date",
    ), ["service_id"])
    return trips.select("trip_id", "route_id", "service_id", "shape_id").join(
        service, "service_id", "left"
    ).select("trip_id", "route_id", "service_id", "shape_id", *params.WEEKDAYS, "start_date", "end_date")


def dim_date(bounds: DataFrame, holidays: DataFrame | None = None, iso_weekday: bool = False) -> DataFrame:
    """Every day from ``start`` to ``end`` of the one-row ``bounds``.

    ``holidays`` has a ``date`` column.  Weekdays count from Sunday = 1, or
    from Monday = 1 with ``iso_weekday``.
    """
    day = F.col("date")
    number = F.weekday(day) + 1 if iso_weekday else F.dayofweek(day)
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("date"))
    if holidays is None:
        days = days.withColumn("is_public_holiday", F.lit(0))
    else:
        marked = holidays.select("date").distinct().withColumn("_off", F.lit(1))
        days = days.join(marked, "date", "left").withColumn(
            "is_public_holiday", F.coalesce("_off", F.lit(0))
        )
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        number.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.when(F.weekday(day) >= 5, 1).otherwise(0).alias("is_weekend"),
        "is_public_holiday",
    )


def calendar_bounds(
    spark, start: dt.date = params.CALENDAR_START, end: dt.date = params.CALENDAR_END
) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def fact_schedule(
    stop_times: DataFrame, wrap_hours: bool = False, bands=params.PEAK_HOURS
) -> DataFrame:
    departure = clock.gtfs_seconds(F.col("departure_time"))
    hour = clock.service_hour(F.col("departure_secs"), wrap_hours)
    return (
        stop_times.select(
            "trip_id", "stop_id",
            F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
            "arrival_time", "departure_time",
            clock.gtfs_seconds(F.col("arrival_time")).alias("arrival_secs"),
            departure.alias("departure_secs"),
        )
        .withColumn("departure_hour", hour)
        .withColumn("is_peak_hour", clock.peak_flag(F.col("departure_hour"), bands))
    )


def weather_daily(raw: DataFrame, rain_threshold: float = params.RAIN_THRESHOLD_MM) -> DataFrame:
    """Daily rows (date, max, min, precipitation, wind, code) with derived features."""
    return raw.select(
        "date", "temp_max_c", "temp_min_c",
        ((F.col("temp_max_c") + F.col("temp_min_c")) / 2).alias("temp_avg_c"),
        "precipitation_mm", "windspeed_max_kmh", "weather_code",
        measures.weather_label(F.col("weather_code")).alias("weather_label"),
        F.when(F.col("precipitation_mm") > rain_threshold, 1).otherwise(0).alias("is_rainy_day"),
    )


# --- Vehicle positions --------------------------------------------------------

def inside_city(pings: DataFrame, lat_range=params.BOX_LAT, lon_range=params.BOX_LON) -> DataFrame:
    return pings.where(geo.in_box(F.col("latitude"), F.col("longitude"), lat_range, lon_range))


def one_per_instant(pings: DataFrame) -> DataFrame:
    """One row per (vehicle_id, timestamp): the earliest ingested."""
    return keep_first(pings, ["vehicle_id", "timestamp"], ["ingested_at", "entity_id"])


def with_previous(pings: DataFrame, *carried: str) -> DataFrame:
    """Add ``_at`` and ``_prev``: place, time and the carried columns of the vehicle's ping before."""
    here = F.struct(
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.unix_micros("_at").alias("us"), *carried
    )
    timed = pings.withColumn("_at", clock.instant(F.col("timestamp")))
    return last_before(timed, "vehicle_id", "_at", here, "_prev", tie=["timestamp"])


def speed_since_previous(
    limit: float | None = params.MAX_SPEED_KMH, radius_km: float = params.EARTH_RADIUS_KM
) -> Column:
    """Speed from ``_prev``, NULL for first pings and above the limit."""
    km = geo.haversine_km(
        F.col("_prev.lat"), F.col("_prev.lon"), F.col("latitude"), F.col("longitude"), radius_km
    )
    speed = geo.speed_kmh(km, (F.unix_micros("_at") - F.col("_prev.us")) / 1e6)
    return speed if limit is None else geo.clamp_speed(speed, limit)


def with_speed(
    pings: DataFrame,
    limit: float | None = params.MAX_SPEED_KMH,
    radius_km: float = params.EARTH_RADIUS_KM,
) -> DataFrame:
    """Speed from the vehicle's previous ping.  Works on de-duplicated pings."""
    linked = with_previous(pings)
    return linked.withColumn("derived_speed_kmh", speed_since_previous(limit, radius_km)).drop("_prev", "_at")


def with_wall_clock(pings: DataFrame) -> DataFrame:
    """Stored ``ping_date`` and ``ping_hour``, so later filters prune files."""
    local = F.col("timestamp")
    return pings.withColumn("ping_date", clock.wall_date(local, strict=False)).withColumn(
        "ping_hour", clock.wall_hour(local, strict=False)
    )


def vehicle_positions(bronze: DataFrame, lat_range=params.BOX_LAT, lon_range=params.BOX_LON) -> DataFrame:
    """Box filter, de-duplication, speed and clamp, in that order."""
    pings = one_per_instant(inside_city(bronze.select(*names(BRONZE_POSITIONS)), lat_range, lon_range))
    silver = with_wall_clock(with_speed(pings))
    return silver.select(*names(FACT_POSITIONS), "ping_date", "ping_hour")


def with_ingest_day(pings: DataFrame) -> DataFrame:
    """Stored ``ingest_day``, so that an incremental load reads recent folders only."""
    return pings.withColumn("ingest_day", clock.ingest_second(F.col("ingested_at")).cast("date"))


def newer_than(rows: DataFrame, watermark: dt.datetime | None) -> DataFrame:
    """Rows ingested after the watermark; all rows when there is none."""
    if watermark is None:
        return rows
    if "ingest_day" in rows.columns:
        rows = rows.where(F.col("ingest_day") >= F.lit(watermark.date()))
    return rows.where(clock.ingest_second(F.col("ingested_at")) > clock.wall(watermark))


def typed_observations(raw: DataFrame, ingested_at=None, id_type: str = "bigint") -> DataFrame:
    """Text columns of the observation export to their types; bad values become NULL."""
    return raw.select(
        F.col("id").try_cast(id_type).alias("id"),
        "route_id", "bus_number", "problem_type", "severity", "status", "description",
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.try_to_timestamp("observed_at").alias("observed_at"),
        F.try_to_timestamp("created_at").alias("created_at"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )
