"""The spacing rule as a keyed event-time stream.

Rows of a key wait in its state until the watermark has passed them.  Then no
earlier row can come any more, and they are judged in time order against the
last row kept, as the batch rule judges them: a row within the window after it
is a duplicate, and of rows at one instant the lowest id goes first.  So rows
may come in any order inside the lateness and get the verdicts of one batch.

A key holds one timer, at its earliest waiting row, and the instant last kept for
as long as a row could fall into its window; the rest of its state is what came
within the lateness.  State lies in RocksDB, with the progress in the query's checkpoint, so
a lost executor or driver goes on from there.

Rows later than the lateness are the watermark's to drop; they get no verdict.
The newest rows wait until the feed goes on, so a feed that ends sends a row
with a later time, a heartbeat: it needs no id and no key.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from omnibus import params
from omnibus.plans import observations as obs
from omnibus.session import prepare
from omnibus.streaming.observations import SUBMISSION

VERDICTS = "qr_code_id bigint, anonymous_identifier string, created_at timestamp, id bigint, verdict string"
LATENESS = "1 day"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class KeepSpaced(StatefulProcessor):
    """Judges the rows (keys, t, id) of a key; t is in microseconds."""

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t bigint, id bigint")
        self.kept = handle.getValueState("kept", "t bigint")
        self.timer = handle.getValueState("timer", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(row["t"], row["id"]) for row in rows]
        self.waiting.appendList(new)
        self._wake_at(min(t for t, _ in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # What lies before the watermark is complete.
        complete = timerValues.getCurrentWatermarkInMs() * 1000
        held = list(self.waiting.get())
        due, rest = sorted(r for r in held if r[0] < complete), [r for r in held if r[0] >= complete]
        last = self.kept.get()[0] if self.kept.exists() else None
        self.timer.clear()
        if rest:
            self.waiting.put(rest)
            self._wake_at(min(t for t, _ in rest))
        else:
            self.waiting.clear()
        for t, row_id in due:
            free = last is None or t - last > self.window_us
            last = t if free else last
            yield Row(
                qr_code_id=key[0], anonymous_identifier=key[1], t=t, id=row_id, verdict="accepted" if free else "duplicate"
            )
        if rest or last is not None and last + self.window_us >= complete:
            if last is not None:
                self.kept.update((last,))
            if not rest:
                self._wake_at(last + self.window_us)
        else:
            # No row within the window of the last kept one can come any more.
            self.kept.clear()

    def _wake_at(self, t: int) -> None:
        ms = t // 1000 + 1  # all of this instant lies before it
        if self.timer.exists():
            (before,) = self.timer.get()
            if before <= ms:
                return
            self.handle.deleteTimer(before)
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def close(self) -> None:
        pass


def verdicts(
    submissions: DataFrame, qr_codes: DataFrame, window_minutes: int = params.DUPLICATE_WINDOW_MINUTES, lateness: str = LATENESS
) -> DataFrame:
    """The verdicts of a stream of submissions, each once."""
    screened = obs.screen(submissions.withWatermark("created_at", lateness), qr_codes)
    shown = [c.split()[0] for c in VERDICTS.split(", ")]
    at_once = screened.where(F.col("verdict").isNotNull() & F.col("id").isNotNull()).select(*shown)
    judged = (
        screened.where(F.col("verdict").isNull())
        .select(*obs.SPACING_KEYS, "created_at", F.unix_micros("created_at").alias("t"), "id")
        .groupBy(*obs.SPACING_KEYS)
        .transformWithState(
            KeepSpaced(window_minutes * 60_000_000),
            "qr_code_id bigint, anonymous_identifier string, t bigint, id bigint, verdict string",
            outputMode="append",
            timeMode="EventTime",
        )
        .withColumn("created_at", F.timestamp_micros("t"))
    )
    return at_once.unionByName(judged.select(*shown))


def run_spaced_intake(
    spark: SparkSession, incoming: str, qr_codes: DataFrame, out: str, checkpoint: str, lateness: str = LATENESS,
    files_per_batch: int | None = None,
) -> None:
    """Judge all submission files that have come, and append the verdicts that are due to ``out``."""
    prepare(spark).conf.set(_PROVIDER, _ROCKSDB)
    reader = spark.readStream.schema(SUBMISSION)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        verdicts(reader.parquet(incoming), qr_codes, lateness=lateness)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def heartbeat(spark: SparkSession, at: Column) -> DataFrame:
    """A submission row without id and key, at a time that lets earlier rows be judged."""
    empty = spark.createDataFrame([()], "").select(
        *[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in SUBMISSION.split(", "))]
    )
    return empty.withColumn("created_at", at)
