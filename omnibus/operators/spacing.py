"""Greedy spacing: keep a row only if the last kept row is far enough back.

Per key, in time order, a row is kept when no kept row lies within the window
before it (the window's edge counts as within).  Dropped rows do not extend
the window, so each verdict hangs on the one before it.  Three facts make it a
distributed job all the same:

* Of rows with one key and instant at most the first can be kept, so the table
  shrinks to distinct instants in a map-side aggregate.
* A pause longer than the window restarts the chain, so the runs between such
  pauses are independent of each other.
* Runs of bounded size are folded as one array.  Longer runs are solved exactly
  by pointer doubling: every instant points at the instant that would be kept
  next, and log2(kept rows) joins on (key, instant) mark those reachable from
  the start of the run.  No task ever holds a whole long run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnibus.sources.shared import cut

_US = 1_000_000
#: Points of a run that is folded: what one task holds at once.
FOLD_LIMIT = 200_000
#: Kept points of a fold are gathered in blocks of so many, as an array is copied with each point added to it.
BLOCK = 256


def keep_spaced(
    df: DataFrame,
    keys: list[str],
    at: str,
    row_id: str,
    window_seconds: int,
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """The kept rows as (keys, at, row_id); ties on one instant go to the lowest id.

    Keys and times must not be NULL; such rows are the caller's to judge.
    """
    points = (
        df.groupBy(*keys, F.unix_micros(at).alias("_t"))
        .agg(F.min(row_id).alias(row_id))
        .where(F.col("_t").isNotNull())
    )
    span = window_seconds * _US
    grain = max(span // 60, 1)
    # Used three times below and much smaller than its input, so it is stored once.
    points = cut(points.withColumn("_slot", F.floor(F.col("_t") / grain)))
    slots = cut(_runs(points, keys, span))
    rows = points.join(slots.drop("_lo"), [*keys, "_slot"])

    kept = _fold(rows.where(F.col("_run_n") <= fold_limit), keys, row_id, span)
    long_slots = slots.where(F.col("_run_n") > fold_limit)
    if not long_slots.isEmpty():
        long_rows = cut(rows.where(F.col("_run_n") > fold_limit))
        kept = kept.unionByName(_doubling(long_rows, long_slots, keys, row_id, span, grain))
    return kept.select(*keys, F.timestamp_micros("_t").alias(at), row_id)


def _runs(points: DataFrame, keys: list[str], span: int) -> DataFrame:
    """Per (key, slot): the run it belongs to, with the run's bounds and size.

    A slot is a sixtieth of the window, so no run can start inside one; the
    windows below walk slots, of which a key has a bounded number per day.
    """
    slots = points.groupBy(*keys, "_slot").agg(
        F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.count("*").alias("_n")
    )
    walk = Window.partitionBy(*keys).orderBy("_slot")
    before = F.lag("_hi").over(walk)
    starts = F.when(before.isNull() | (F.col("_lo") - before > span), F.col("_slot"))
    run = Window.partitionBy(*keys, "_run")
    return (
        slots.withColumn("_start", starts)
        .withColumn("_run", F.last("_start", ignorenulls=True).over(walk))
        .withColumn("_run_lo", F.min("_lo").over(run))
        .withColumn("_run_hi", F.max("_hi").over(run))
        .withColumn("_run_n", F.sum("_n").over(run))
        .select(*keys, "_slot", "_lo", "_run", "_run_lo", "_run_hi", "_run_n")
    )


def _fold(rows: DataFrame, keys: list[str], row_id: str, span: int) -> DataFrame:
    """Runs of bounded size: one pass over the sorted instants of a run."""
    point = F.struct(F.col("_t"), F.col(row_id))
    runs = rows.groupBy(*keys, "_run").agg(F.array_sort(F.collect_list(point)).alias("_points"))
    kind = runs.schema["_points"].dataType.simpleString()
    empty = lambda t: F.array().cast(t)
    start = F.struct(
        empty(f"array<{kind}>").alias("blocks"), empty(kind).alias("block"), F.lit(None).cast("bigint").alias("last")
    )

    def step(kept, p):
        full = F.size(kept["block"]) >= BLOCK
        after = F.struct(
            F.when(full, F.concat(kept["blocks"], F.array(kept["block"]))).otherwise(kept["blocks"]).alias("blocks"),
            F.when(full, F.array(p)).otherwise(F.concat(kept["block"], F.array(p))).alias("block"),
            p["_t"].alias("last"),
        )
        return F.when(kept["last"].isNull() | (p["_t"] - kept["last"] > span), after).otherwise(kept)

    gather = lambda kept: F.concat(F.flatten(kept["blocks"]), kept["block"])
    kept = runs.select(*keys, F.explode(F.aggregate("_points", start, step, gather)).alias("_p"))
    return kept.select(*keys, F.col("_p._t").alias("_t"), F.col(f"_p.{row_id}").alias(row_id))


def _successors(rows: DataFrame, slots: DataFrame, keys: list[str], span: int, grain: int) -> DataFrame:
    """(keys, t, next): the instant kept next if t is kept; rows without one are left out."""
    # Within the slot that t + window falls in: the first instant after it.
    probe = F.col("_t") + span
    nothing = F.lit(None).cast("bigint")
    marks = rows.select(*keys, "_slot", "_t", F.col("_t").alias("_hit"), nothing.alias("_from"), "_run_hi")
    probes = rows.select(
        *keys, F.floor(probe / grain).alias("_slot"), probe.alias("_t"),
        nothing.alias("_hit"), F.col("_t").alias("_from"), "_run_hi",
    )
    # Walk backwards in time; a probe comes before a mark at the same instant.
    down = Window.partitionBy(*keys, "_slot").orderBy(F.desc("_t"), F.desc_nulls_last("_from"))
    found = (
        marks.unionByName(probes)
        .withColumn("_hit", F.last("_hit", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("_from").isNotNull())
    )
    # Else the first instant of the next slot that has any.
    wanted = found.select(*keys, "_slot").distinct().withColumn("_lo", nothing)
    later = Window.partitionBy(*keys).orderBy(F.desc("_slot"))
    lookup = (
        slots.select(*keys, "_slot", "_lo")
        .unionByName(wanted)
        .groupBy(*keys, "_slot")
        .agg(F.max("_lo").alias("_lo"))
        .withColumn("_after", F.last("_lo", ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1)))
    )
    hops = found.join(lookup.drop("_lo"), [*keys, "_slot"], "left")
    # A hop that leaves the run lands on the start of another run, kept anyway.
    return hops.select(
        *keys, F.col("_from").alias("_t"), F.coalesce("_hit", "_after").alias("_next"), "_run_hi"
    ).where(F.col("_next") <= F.col("_run_hi")).drop("_run_hi")


def _doubling(rows, slots, keys, row_id, span, grain) -> DataFrame:
    hops = cut(_successors(rows, slots, keys, span, grain))
    reached = rows.where(F.col("_t") == F.col("_run_lo")).select(*keys, "_t")
    while not hops.isEmpty():
        onward = hops.join(reached, [*keys, "_t"], "left_semi").select(*keys, F.col("_next").alias("_t"))
        reached = cut(reached.unionByName(onward).distinct())
        second = hops.select(*keys, F.col("_t").alias("_next"), F.col("_next").alias("_next2"))
        hops = cut(hops.join(second, [*keys, "_next"]).select(*keys, "_t", F.col("_next2").alias("_next")))
    return rows.join(reached, [*keys, "_t"], "left_semi").select(*keys, "_t", row_id)
