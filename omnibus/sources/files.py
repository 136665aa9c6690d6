"""Scans of landed files and the observation export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus import params, schemas
from omnibus.functions import clock


def read_gtfs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The schedule text files under ``folder``, untransformed.

    Columns are matched by header name, in any order; missing ones are NULL and
    others are left out.  Empty fields are NULL.
    """
    return {name: _gtfs_file(spark, f"{folder}/{name}.txt", ddl) for name, ddl in schemas.GTFS_FILES.items()}


def _gtfs_file(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return chosen_columns(spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"'), ddl)


def chosen_columns(raw: DataFrame, ddl: str) -> DataFrame:
    """The columns of ``ddl`` by name; missing ones are NULL."""
    return raw.select(
        *[
            (F.col(c) if c in raw.columns else F.lit(None).cast("string")).alias(c)
            for c in schemas.names(ddl)
        ]
    )


def read_weather(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Daily rows of JSON documents that hold one array per measure.

    A file is one document, unless it holds ``one_per_line``.
    """
    return weather_days(spark.read.schema(schemas.WEATHER_DOCUMENT).json(path, multiLine=not one_per_line))


def weather_days(docs: DataFrame) -> DataFrame:
    day = F.explode(
        F.arrays_zip(
            "daily.time", "daily.temperature_2m_max", "daily.temperature_2m_min",
            "daily.precipitation_sum", "daily.windspeed_10m_max", "daily.weathercode",
        )
    )
    return docs.select(day.alias("d")).select(
        F.col("d.time").alias("date"),
        F.col("d.temperature_2m_max").alias("temp_max_c"),
        F.col("d.temperature_2m_min").alias("temp_min_c"),
        F.col("d.precipitation_sum").alias("precipitation_mm"),
        F.col("d.windspeed_10m_max").alias("windspeed_max_kmh"),
        F.col("d.weathercode").alias("weather_code"),
    )


def read_fuel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.FUEL_CSV)


def read_access(spark: SparkSession, path: str) -> DataFrame:
    """Which user sees which route, as exported from the directory."""
    return spark.read.csv(path, header=True, schema=schemas.USER_ROUTE_ACCESS)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """The export with every column as text; empty fields are '' and never NULL."""
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    return raw.fillna("")


def export_observations(
    observations: DataFrame,
    folder: str,
    as_of: dt.datetime,
    days: int = params.EXPORT_DAYS,
    cap: int | None = None,
) -> str:
    """Write the last ``days`` days, newest first; 0 days means all, ``cap`` the newest rows only.

    The rows are range-sorted over as many files as Spark chooses.
    """
    path = f"{folder.rstrip('/')}/observations_{as_of:%Y%m%d}.csv"
    exported(observations, as_of, days, cap).write.csv(path, header=True, escape='"', emptyValue="", nullValue="")
    return path


def exported(observations: DataFrame, as_of: dt.datetime, days: int, cap: int | None = None) -> DataFrame:
    df = observations
    if days:
        df = df.where(F.col("created_at") >= clock.days_before(as_of, days))
    df = df.orderBy(F.desc("created_at"), F.desc("id"))
    if cap is not None:
        df = df.limit(cap)
    text = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return df.select(*params.EXPORT_COLUMNS).withColumns(
        {c: F.date_format(c, text) for c in ("observed_at", "created_at")}
    )
