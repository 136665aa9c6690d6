"""The folder all executors can reach, for cut lineage and interim files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; where none is named, one beside the tables.

    The warehouse is as shared as the tables in it, so no session writes to a
    folder of one machine; on a cluster whose warehouse is one, a folder has to be named.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder that all executors share; the warehouse is {warehouse}")
        named = f"{warehouse.rstrip('/')}/_interim"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut(df):
    """Checkpoint to the shared folder, so a lost executor replays nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
