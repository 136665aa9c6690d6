"""Runtime settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # A hot key of a shuffle join is split over several tasks ...
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... also where a later step on the same key then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Instants are UTC; days and wall-clock text are cut from them in this zone.
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
