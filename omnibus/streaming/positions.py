"""Realtime cycle: land snapshots, build silver incrementally, load the warehouse.

Both streams keep their progress in checkpoints.  A batch that is replayed after
a failure finds the pings it stored before and adds only the missing ones.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus import params, schemas
from omnibus.functions import clock
from omnibus.operators.dedupe import keep_last
from omnibus.operators.quality import QualityGateFailed, gate
from omnibus.operators.skew import rekeyed
from omnibus.plans import activity, checks, loads, silver
from omnibus.session import prepare
from omnibus.sources import tables, versioned
from omnibus.sources.shared import cut


def entities(snapshots: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per feed entity of the snapshots."""
    vehicle = [c for c in schemas.names(schemas.BRONZE_POSITIONS) if c not in ("entity_id", "ingested_at")]
    return (
        snapshots.select(F.explode("entity").alias("e"))
        .select(F.col("e.id").alias("entity_id"), *[F.col(f"e.vehicle.{c}").alias(c) for c in vehicle])
        .withColumn("ingested_at", ingested_at)
    )


def batch_time() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def land(
    spark: SparkSession, incoming: str, bronze: str, checkpoint: str,
    ingested_at: Column | None = None, files_per_batch: int | None = None,
) -> None:
    """Append every new snapshot file to bronze, which is never rewritten."""
    reader = spark.readStream.schema(schemas.POSITION_SNAPSHOT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = entities(reader.json(incoming), batch_time() if ingested_at is None else ingested_at)
    query = (
        rows.writeStream.format("parquet").option("path", bronze).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


_PING = (
    "struct<at: timestamp, timestamp: string, entity_id: string, latitude: double, longitude: double, "
    "ingest_day: date, ping_date: date>"
)


class SilverBuilder:
    """The foreachBatch body that turns new bronze rows into silver rows.

    Silver always equals ``silver.vehicle_positions`` over all bronze rows so
    far, however late they come.  Besides silver, the first and last ping of
    each vehicle and day are kept.  A new ping can only change its own speed and
    that of the ping after it.  Both have their neighbours on one of the batch's
    own days, or they are first or last pings of other days; so silver is read
    on the batch's days alone.

    New pings are appended.  A stored ping whose predecessor is new gets its
    speed corrected: its partition is rewritten, and the correction is logged
    for the warehouse.  The order of the writes (corrections, day ends, new
    pings) lets a replay repeat any part of them.
    """

    def __init__(
        self, spark: SparkSession, schema: str, root: str,
        lat_range=params.BOX_LAT, lon_range=params.BOX_LON,
    ):
        self.box = (lat_range, lon_range)
        self.positions = f"{schema}.silver_vehicle_positions"
        self.day_ends = f"{schema}.silver_day_ends"
        self.corrections = f"{schema}.silver_speed_corrections"
        stored = f"{schemas.FACT_POSITIONS}, ping_hour int, batch_id bigint, ingest_day date, ping_date date"
        ends = f"vehicle_id string, first_ping {_PING}, last_ping {_PING}, utc_day date"
        fixes = (
            "vehicle_id string, timestamp string, derived_speed_kmh double, ingest_day date, ping_date date, "
            "batch_id bigint"
        )
        versioned.ensure(spark, self.positions, stored, loads.POSITION_PARTITIONS, root)
        versioned.ensure(spark, self.day_ends, ends, ("utc_day",), root)
        tables.ensure(spark, self.corrections, fixes, ("batch_id",), root)

    def silver(self, spark: SparkSession) -> DataFrame:
        return tables.read(spark, self.positions)

    def latest(self, spark: SparkSession) -> DataFrame:
        """Latest ping per vehicle."""
        ends = tables.read(spark, self.day_ends)
        return keep_last(ends, ["vehicle_id"], ["utc_day"]).select("vehicle_id", "last_ping.*")

    def __call__(self, bronze: DataFrame, batch_id: int) -> None:
        spark = bronze.sparkSession
        columns = schemas.names(schemas.BRONZE_POSITIONS)
        pings = silver.one_per_instant(silver.inside_city(bronze.select(*columns), *self.box))
        # Cut once: the batch is used by every step below.
        batch = cut(_dated(silver.with_ingest_day(silver.with_wall_clock(pings))))
        found = batch.select(F.unix_date("ping_date").alias("wall"), F.unix_date("utc_day").alias("utc"))
        found = found.distinct().collect()  # pairs of calendar days
        walls, days = {r["wall"] for r in found}, {r["utc"] for r in found} - {None}

        # Copies of a ping share its text, so only the batch's dates are read.
        seen = self.silver(spark).where(tables.on_days("ping_date", walls)).select("vehicle_id", "timestamp")
        match = batch["vehicle_id"].eqNullSafe(seen["vehicle_id"]) & batch["timestamp"].eqNullSafe(seen["timestamp"])
        fresh = cut(batch.join(seen, match, "left_anti"))

        marked = fresh.withColumn("_role", F.lit("new"))
        for near in self._beside(spark, fresh, days):
            marked = marked.unionByName(near, allowMissingColumns=True)
        linked = cut(
            silver.with_previous(marked, "_role").withColumn("derived_speed_kmh", silver.speed_since_previous())
        )
        self._correct(spark, linked, batch_id)
        self._extend_days(spark, fresh, days)
        rows = linked.where("_role = 'new'").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        versioned.append(rows, self.positions)

    def _beside(self, spark: SparkSession, fresh: DataFrame, days: set[int]) -> list[DataFrame]:
        """Stored pings that may come right before or after a new one, with what they may become."""
        movers = rekeyed(fresh.where(F.col("utc_day").isNotNull()).select("vehicle_id"), "vehicle_id")
        # A wall-clock date is at most one day off the UTC day.
        around = {d + k for d in days for k in (-1, 0, 1)}
        stored = _dated(self.silver(spark).where(tables.on_days("ping_date", around))).where(tables.on_days("utc_day", days))
        ends = tables.read(spark, self.day_ends).where(~tables.on_days("utc_day", days))
        ends = ends.join(movers, "vehicle_id", "left_semi")
        shown = ["vehicle_id", "timestamp", "latitude", "longitude", "ingest_day", "ping_date"]
        first = ends.select("vehicle_id", "first_ping.*").select(*shown, F.lit("stored").alias("_role"))
        last = ends.where("last_ping <> first_ping").select("vehicle_id", "last_ping.*")
        return [
            stored.join(movers, "vehicle_id", "left_semi").select(*shown, F.lit("stored").alias("_role")),
            first,
            # Its predecessor may be missing here, and is not new.
            last.select(*shown, F.lit("before").alias("_role")),
        ]

    def _correct(self, spark: SparkSession, linked: DataFrame, batch_id: int) -> None:
        moved = linked.where("_role = 'stored' AND _prev._role = 'new'")
        if moved.isEmpty():
            return
        keys = ("vehicle_id", "timestamp", "derived_speed_kmh", *loads.POSITION_PARTITIONS)
        corrected = moved.select(*keys)
        tables.insert(corrected.withColumn("batch_id", F.lit(batch_id).cast("bigint")), self.corrections, ("batch_id",))
        loads.correct_speeds(spark, self.positions, corrected)

    def _extend_days(self, spark: SparkSession, fresh: DataFrame, days: set[int]) -> None:
        timed = fresh.where(F.col("vehicle_id").isNotNull() & F.col("utc_day").isNotNull())
        names = [part.split(":")[0] for part in _PING[len("struct<"):-1].split(", ")]
        ping = F.struct(*names)
        new = timed.select("vehicle_id", "utc_day", ping.alias("first_ping"), ping.alias("last_ping"))
        both = tables.read(spark, self.day_ends).where(tables.on_days("utc_day", days)).unionByName(new)
        ends = both.groupBy("vehicle_id", "utc_day").agg(
            F.min("first_ping").alias("first_ping"), F.max("last_ping").alias("last_ping")
        )
        versioned.replace(ends, self.day_ends, {(d,) for d in days})


def _dated(pings: DataFrame) -> DataFrame:
    at = clock.instant(F.col("timestamp"))
    return pings.withColumn("at", at).withColumn("utc_day", at.cast("date"))


def build_silver(
    spark: SparkSession, bronze: str, builder: SilverBuilder, checkpoint: str, files_per_batch: int | None = None
) -> None:
    reader = spark.readStream.schema(schemas.BRONZE_POSITIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(bronze).writeStream.foreachBatch(builder).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def realtime_cycle(
    spark: SparkSession, incoming: str, root: str, schema: str, *,
    ingested_at: Column | None = None, files_per_batch: int | None = None,
    retries: int = 1, wait_seconds: float = 30.0, keep_activity: bool = False,
) -> SilverBuilder:
    """Land, build silver, gate, load.

    The load runs only after the steps before it succeeded, and only if the new
    pings pass the checks; the row-level ones are counted by the load itself,
    before its rows can be seen.  ``keep_activity`` also brings the partial aggregates
    of the activity views up to date, for the days that the load touched.
    """
    prepare(spark)
    builder = SilverBuilder(spark, schema, f"{root}/silver")

    def ingest():
        land(spark, incoming, f"{root}/bronze_positions", f"{root}/checkpoints/land", ingested_at, files_per_batch)
        build_silver(spark, f"{root}/bronze_positions", builder, f"{root}/checkpoints/silver", files_per_batch)

    def load():
        rows, corrections = builder.silver(spark), tables.read(spark, builder.corrections)
        if keep_activity:
            fixed = loads.pending_corrections(spark, corrections, schema).select(*activity.DAY)
            new = loads.pending_positions(spark, rows, schema).select(*activity.DAY)
            activity.touch(spark, schema, versioned.parts_of(new.unionByName(fixed), activity.DAY))
        gate(checks.unique_pings(loads.pending_positions(spark, rows, schema)))
        rules = checks.ping_row_rules(*builder.box)
        loads.load_positions(spark, rows, schema, f"{root}/warehouse", rules=rules)
        loads.correct_positions(spark, corrections, schema)
        if keep_activity:
            activity.refresh(spark, schema, f"{root}/warehouse")

    for step in (ingest, load):
        for attempt in range(retries + 1):
            try:
                step()
                break
            except QualityGateFailed:
                raise
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(wait_seconds)
    return builder
