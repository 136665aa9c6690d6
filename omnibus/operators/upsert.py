"""Row-level upsert for file tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnibus.operators.dedupe import repeated_keys


class RepeatedSourceKey(ValueError):
    """More than one source row would update the same target row."""


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target after the merge: matched rows replaced, new rows added, the rest kept."""
    clash = repeated_keys(source.where(F.col(key).isNotNull()), [key])
    if not clash.isEmpty():
        raise RepeatedSourceKey(f"source holds several rows for one {key}")
    return target.join(source.select(key), key, "left_anti").unionByName(source)
