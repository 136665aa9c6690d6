"""Silver to warehouse loads."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus import schemas
from omnibus.functions import clock
from omnibus.operators.dedupe import keep_last
from omnibus.operators.upsert import upsert
from omnibus.plans import silver
from omnibus.plans.gold import GOLD_VIEWS
from omnibus.sources import tables, versioned
from omnibus.sources.shared import cut

STAR = {
    "dim_route": schemas.DIM_ROUTE,
    "dim_stop": schemas.DIM_STOP,
    "dim_trip": schemas.DIM_TRIP,
    "dim_date": schemas.DIM_DATE,
    "fact_schedule": schemas.FACT_SCHEDULE,
    "fact_weather_daily": schemas.FACT_WEATHER,
    "fact_fuel_prices": schemas.FACT_FUEL,
}
POSITIONS = "fact_vehicle_positions"
POSITION_PARTITIONS = ("ingest_day", "ping_date")
OBSERVATIONS = "bronze_observations"
OBSERVATION_DAY = "created_day"
OBSERVATION_INDEX = "bronze_observation_days"
ID_BUCKET = "id_bucket"
#: Rows of an index bucket, about, and least number of buckets, when the table is made; the number then stays.
ROWS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 8
_BUCKETS = "id_buckets"
_CORRECTED = "corrected_to"


def star_columns(name: str, source: DataFrame) -> DataFrame:
    """The table's columns in order; a bad weather or fuel date becomes NULL, the row stays."""
    wanted = [F.col(c) for c in schemas.names(STAR[name])]
    if name in ("fact_weather_daily", "fact_fuel_prices"):
        wanted[0] = F.col("date").try_cast("date").alias("date")
    return source.select(*wanted)


def load_star(sources: dict[str, DataFrame], schema: str, root: str) -> None:
    """Full reload of the batch tables."""
    for name in STAR:
        tables.publish(star_columns(name, sources[name]), f"{schema}.{name}", root)


def load_access(source: DataFrame, schema: str, root: str) -> None:
    """Full reload of the table that row-level security reads; a grant given twice is kept once."""
    rows = source.select(*schemas.names(schemas.USER_ROUTE_ACCESS)).distinct()
    tables.publish(rows, f"{schema}.user_route_access", root)


def watermark(spark: SparkSession, name: str) -> dt.datetime | None:
    """Newest parseable ingestion second of the table.

    Only the partition of the newest ingestion day is read.
    """
    newest = versioned.newest_day(spark, name, "ingest_day")
    if newest is None:
        return None
    last = spark.table(name).where(F.col("ingest_day") == F.lit(dt.date.fromisoformat(newest)))
    return last.agg(F.max(clock.ingest_second(F.col("ingested_at"))).alias("w")).first()["w"]


def position_rows(source: DataFrame) -> DataFrame:
    rows = source if "ingest_day" in source.columns else silver.with_ingest_day(source)
    return rows.select(*schemas.names(schemas.FACT_POSITIONS), "ping_hour", *POSITION_PARTITIONS)


def pending_positions(spark: SparkSession, source: DataFrame, schema: str) -> DataFrame:
    """The silver pings that the next incremental load appends."""
    name = f"{schema}.{POSITIONS}"
    rows = position_rows(source)
    return silver.newer_than(rows, watermark(spark, name)) if tables.exists(spark, name) else rows


def load_positions(
    spark: SparkSession, source: DataFrame, schema: str, root: str, full_reload: bool = False,
    rules: dict[str, Column] | None = None,
) -> None:
    """Append silver pings newer than the warehouse table's watermark, or replace the table.

    Newer is strict, at second grain.  An empty table, or one without any
    parseable ingestion time, takes all rows; otherwise rows whose time does not
    parse stay out.  The table is partitioned by ingestion day, which bounds
    what the next load reads, and by ping date, which the gold views filter on.
    A new row that breaks one of ``rules``, which the load itself counts, stops it.
    """
    name = f"{schema}.{POSITIONS}"
    if full_reload or not tables.exists(spark, name):
        versioned.publish(position_rows(source), name, root, POSITION_PARTITIONS, rules)
    else:
        versioned.append(pending_positions(spark, source, schema), name, rules)


def in_partitions(touched: set[versioned.Part]) -> Column:
    """Rows in one of the given partitions of a pings table, NULL dates included."""

    def same(column: str, days: int | None) -> Column:
        day = F.lit(None).cast("date") if days is None else F.date_from_unix_date(F.lit(days))
        return F.col(column).eqNullSafe(day)

    hits = [reduce(Column.__and__, map(same, POSITION_PARTITIONS, part)) for part in touched]
    return reduce(Column.__or__, hits, F.lit(False))


def correct_speeds(spark: SparkSession, name: str, corrected: DataFrame) -> None:
    """Write corrected speeds into a pings table; the partitions they fall into are rewritten and switched at once.

    ``corrected`` has one row per ping: the keys, the partition columns, the speed.
    """
    touched = versioned.parts_of(corrected, POSITION_PARTITIONS)  # pairs of calendar days
    if not touched:
        return
    keys = ["vehicle_id", "timestamp"]
    speeds = corrected.select(*keys, F.col("derived_speed_kmh").alias("_speed"), F.lit(True).alias("_hit"))
    rows = tables.read(spark, name).where(in_partitions(touched)).join(speeds, keys, "left")
    speed = F.when(F.col("_hit"), F.col("_speed")).otherwise(F.col("derived_speed_kmh"))
    versioned.replace(rows.withColumn("derived_speed_kmh", speed).drop("_speed", "_hit"), name, touched)


def pending_corrections(spark: SparkSession, corrections: DataFrame, schema: str) -> DataFrame:
    """The corrections that the warehouse table has not been brought up to."""
    name = f"{schema}.{POSITIONS}"
    done = tables.mark_of(spark, name, _CORRECTED) if tables.exists(spark, name) else None
    return corrections.where(F.col("batch_id") > int(-1 if done is None else done))


def correct_positions(spark: SparkSession, corrections: DataFrame, schema: str) -> None:
    """Bring the warehouse table up to the corrections (with batch_id) logged since the last call."""
    name = f"{schema}.{POSITIONS}"
    pending = pending_corrections(spark, corrections, schema)
    last = pending.agg(F.max("batch_id").alias("b")).first()["b"]
    if last is None:
        return
    newest = keep_last(pending, ["vehicle_id", "timestamp"], ["batch_id"])
    correct_speeds(spark, name, newest)
    tables.set_mark(spark, name, _CORRECTED, last)


def materialize_gold(model: dict[str, DataFrame], schema: str, root: str) -> None:
    """Store the gold views as tables, for readers that should not recompute them."""
    for name in GOLD_VIEWS:
        tables.publish(model[name], f"{schema}.{name}_gold", root)


def load_observations(
    spark: SparkSession, raw: DataFrame, schema: str, root: str, id_type: str = "bigint", id_buckets: int | None = None
) -> None:
    """First run creates the table, later runs update by id.

    The table is partitioned by creation day.  Beside it stands an index from id
    to day, partitioned by a hash of the id.  An update reads the index buckets of
    its own ids, the days these name and its own, and switches those days at once.

    The index may name a day too many and never one too few: an update first adds
    its pairs, then switches the days, then takes old pairs out.  So a run that
    broke off anywhere leaves both tables right, and can be repeated.
    """
    name, index = f"{schema}.{OBSERVATIONS}", f"{schema}.{OBSERVATION_INDEX}"
    rows = silver.typed_observations(raw, id_type=id_type).withColumn(OBSERVATION_DAY, F.to_date("created_at"))
    if not tables.exists(spark, name):
        rows = cut(rows)
        id_buckets = id_buckets or max(LEAST_BUCKETS, rows.count() // ROWS_PER_BUCKET)
        versioned.publish(_days_by_id(rows, id_buckets), index, root, (ID_BUCKET,))
        tables.set_mark(spark, index, _BUCKETS, id_buckets)
        versioned.publish(rows, name, root, (OBSERVATION_DAY,))
        return
    source = cut(rows)
    pairs = cut(_days_by_id(source, int(tables.mark_of(spark, index, _BUCKETS))))
    known = index_rows(spark, index, pairs)
    own = pairs.select("id").distinct()
    touched = versioned.parts_of(
        known.join(own, "id", "left_semi").select(OBSERVATION_DAY).unionByName(source.select(OBSERVATION_DAY)), (OBSERVATION_DAY,)
    )
    days = {part[0] for part in touched}
    merged = upsert(tables.read(spark, name).where(tables.on_days(OBSERVATION_DAY, days)), source, "id")
    versioned.append(pairs, index)
    versioned.replace(merged, name, touched)
    buckets = versioned.parts_of(pairs, (ID_BUCKET,))
    versioned.replace(known.join(own, "id", "left_anti").unionByName(pairs), index, buckets)


def _days_by_id(rows: DataFrame, id_buckets: int) -> DataFrame:
    """(id, day, bucket) of the rows that an update may find by id."""
    bucket = F.pmod(F.xxhash64("id"), F.lit(id_buckets)).cast("int").alias(ID_BUCKET)
    return rows.where(F.col("id").isNotNull()).select("id", OBSERVATION_DAY, bucket)


def index_rows(spark: SparkSession, index: str, pairs: DataFrame) -> DataFrame:
    """The index buckets that the ids of ``pairs`` fall into, each pair once."""
    buckets = [part[0] for part in versioned.parts_of(pairs, (ID_BUCKET,))]  # one a bucket
    return tables.read(spark, index).where(F.col(ID_BUCKET).isin(*buckets) if buckets else F.lit(False)).distinct()
