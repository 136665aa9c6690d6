"""Observation intake as a stream of submission files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus import params, schemas
from omnibus.plans import observations as obs
from omnibus.session import prepare
from omnibus.sources import tables

CLASSIFIED = (
    "qr_token string, id bigint, problem_type string, severity string, description string, "
    "observed_at timestamp, latitude double, longitude double, anonymous_identifier string, "
    "created_at timestamp, qr_code_id bigint, bus_number string, route_id string, verdict string"
)
SUBMISSION = (
    "id bigint, qr_token string, problem_type string, severity string, description string, "
    "observed_at timestamp, latitude double, longitude double, anonymous_identifier string, "
    "created_at timestamp"
)


class Intake:
    """The foreachBatch body: classify a batch against what was accepted before.

    The verdicts are partitioned by batch and submission day, so a replayed
    batch replaces itself, and the look-back reads only the days that matter.
    """

    def __init__(self, spark: SparkSession, qr_codes: DataFrame, name: str, root: str,
                 window_minutes: int = params.DUPLICATE_WINDOW_MINUTES):
        self.qr_codes, self.name, self.window_minutes = qr_codes, name, window_minutes
        tables.ensure_batches(spark, name, f"{CLASSIFIED}, batch_id bigint, created_day date", ("created_day",), root)

    def classified(self, spark: SparkSession) -> DataFrame:
        return tables.read(spark, self.name)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = obs.classify(batch, self.qr_codes, self.window_minutes, self._recent(batch, batch_id))
        dated = rows.withColumn("created_day", F.to_date("created_at"))
        columns = [*schemas.names(CLASSIFIED), "created_day"]
        tables.write_batch(dated.select(*columns), self.name, batch_id, ("created_day",))

    def _recent(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """Accepted rows of earlier batches that lie within a window of this one's time span."""
        window = F.make_dt_interval(mins=F.lit(self.window_minutes))
        # Days and seconds come from Spark, so the process's own time zone plays no part.
        span = batch.agg(
            F.to_date(F.min("created_at") - window).alias("first_day"),
            F.to_date(F.max("created_at") + window).alias("last_day"),
        ).first()
        if batch_id == 0 or span["first_day"] is None:
            return None
        return (
            self.classified(batch.sparkSession)
            .where((F.col("batch_id") < batch_id) & F.col("created_day").between(span["first_day"], span["last_day"]))
            .where(F.col("verdict") == "accepted")
            .select(*obs.SPACING_KEYS, F.col("created_at").alias("accepted_at"))
        )


def run_intake(
    spark: SparkSession, incoming: str, intake: Intake, checkpoint: str, files_per_batch: int | None = None
) -> None:
    reader = prepare(spark).readStream.schema(SUBMISSION)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(incoming).writeStream.foreachBatch(intake).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
