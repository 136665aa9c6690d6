"""Global rank without pulling all rows, or all values, into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnibus.sources.shared import cut

#: Distinct values that one task may walk; more of them are cut into stretches, each counted by a task of its own.
FEW_VALUES = 100_000
STRETCHES = 256


def rank_by_value(df: DataFrame, value: str, name: str = "rank", stretches: int = STRETCHES, few: int = FEW_VALUES) -> DataFrame:
    """SQL ``rank() over (order by value desc)`` of a number, date or timestamp; ties share a rank, NULLs come last.

    The distinct values, one row each after a partial aggregate, are cut into
    stretches at their approximate quantiles, unless they are ``few``.  A value's rank is the number of
    rows in the stretches above, plus those above it in its own, plus one; rows
    themselves are never sorted.  How good the quantiles are touches the balance
    of the tasks and not the ranks.
    """
    # Rows and counts are read several times below, so the rows are stored once.
    df = cut(df)
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    so_far = lambda window: F.coalesce(
        F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    if counts.count() <= few:
        ranks = counts.select("_v", (so_far(Window.orderBy(F.col("_v").desc_nulls_last())) + 1).alias(name))
        return df.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")
    shares = [i / stretches for i in range(1, stretches)]
    bounds = counts.agg(F.percentile_approx("_v", shares, 10 * stretches)).first()[0] or []
    kind = counts.schema["_v"].dataType
    higher = F.size(F.filter(F.array(*[F.lit(b).cast(kind) for b in dict.fromkeys(bounds)]), lambda b: b > F.col("_v")))
    placed = counts.withColumn(
        "_at", F.when(F.col("_v").isNull(), F.lit(stretches)).otherwise(higher if bounds else F.lit(0))
    )
    # One row per stretch.
    totals = placed.groupBy(F.col("_at").alias("_part")).agg(F.sum("_n").alias("_n"))
    offsets = totals.select("_part", so_far(Window.orderBy("_part")).alias("_before"))
    inside = Window.partitionBy("_at").orderBy(F.col("_v").desc())
    ranks = (
        placed.withColumn("_inside", so_far(inside))
        .join(offsets, F.col("_at") == F.col("_part"))
        .select("_v", (F.col("_before") + F.col("_inside") + 1).alias(name))
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")
