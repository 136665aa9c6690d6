"""One row per key, chosen by a stated order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """The row with the smallest ``order`` values for each key.

    Written as an aggregate, not as a window: copies of one key collapse on
    the map side, so a key that holds a third of the table never reaches one
    task.  Remaining columns break ties, which makes the survivor
    deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [c for c in order if c in rest] + [c for c in rest if c not in order]
    if not ranked:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return best.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` values for each key."""
    rest = [c for c in df.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_row"))
    return best.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
