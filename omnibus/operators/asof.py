"""Latest earlier value per key, in groups whose size the clock bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def last_before(
    df: DataFrame,
    key: str,
    at: str,
    value: Column,
    name: str,
    tie: list[str] = (),
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add ``name``: the last non-NULL ``value`` strictly before each row.

    A plain ``lag`` over the key would sort a whole key in one task.  Here the
    window runs inside (key, time bucket), and the last value of each earlier
    bucket is carried in from a summary with one row per key and bucket, which
    is small enough to walk per key.

    Both the rows and the summary come from the same keyed input, so Spark
    computes a shuffle below them (such as a de-duplication) once.  Rows with a
    NULL key or time get NULL.
    """
    bucket = F.floor(F.unix_seconds(at) / bucket_seconds)
    # Rows without a time are never anybody's predecessor, so any spread will do.
    spread = -1 - F.pmod(F.hash(*df.columns), F.lit(4096)).cast("long")
    order = [F.col(at), *[F.col(t) for t in tie]]
    keyed = df.where(F.col(key).isNotNull()).withColumn("_value", value)

    in_bucket = Window.partitionBy(key, "_bucket").orderBy(*order)
    before = in_bucket.rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("_bucket", F.coalesce(bucket, spread)).withColumn(
        "_near", F.last("_value", ignorenulls=True).over(before)
    )

    # max_by skips rows whose order is NULL: those without a value or a time.
    carries = F.col("_value").isNotNull() & F.col(at).isNotNull()
    latest = F.max_by("_value", F.when(carries, F.struct(*order))).alias("_last")
    summary = keyed.groupBy(key, bucket.alias("_bucket")).agg(latest)
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(key, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_far"))

    linked = (
        rows.join(carried, [key, "_bucket"], "left")
        .withColumn(name, F.when(F.col(at).isNotNull(), F.coalesce("_near", "_far")))
        .select(*df.columns, name)
    )
    nothing = F.lit(None).cast(linked.schema[name].dataType)
    return linked.unionByName(df.where(F.col(key).isNull()).withColumn(name, nothing))
