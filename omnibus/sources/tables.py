"""Catalog tables that are replaced in one step.

A table name is a view over the stored version in use.  A reload writes and
registers a new version and then replaces the view, so a reader sees the old
rows or the new ones and never an empty or half-filled table, and a failed
write leaves the table as it was.  The files of older versions stay for
readers that still hold them; removing those is a retention job's business.

Names may carry a schema (``gold.dim_route``), so one session reads across
layers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.operators.quality import QualityGateFailed, Watch
from omnibus.sources.shared import cut

STORED = "stored_in"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def stored_in(spark: SparkSession, name: str) -> str:
    """The stored version that the name shows."""
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{STORED}')").first()["value"]


def on_days(column: str, days: set[int | None]) -> Column:
    """Column in a set of days counted from 1970, None for NULL; the catalog answers it for partitions."""
    known = [F.date_from_unix_date(F.lit(d)) for d in sorted(d for d in days if d is not None)]
    hit = F.col(column).isin(*known) if known else F.lit(False)
    return hit | F.col(column).isNull() if None in days else hit


def mark_of(spark: SparkSession, name: str, mark: str) -> str | None:
    """A mark set on the stored version in use; a new version has none."""
    found = spark.sql(f"SHOW TBLPROPERTIES {stored_in(spark, name)}").where(F.col("key") == mark).first()
    return found["value"] if found else None


def set_mark(spark: SparkSession, name: str, mark: str, value: object) -> None:
    spark.sql(f"ALTER TABLE {stored_in(spark, name)} SET TBLPROPERTIES ('{mark}' = '{value}')")


def publish(
    df: DataFrame, name: str, root: str, partition_by: tuple[str, ...] = (), rules: dict[str, Column] | None = None
) -> None:
    """Create the table, or replace all its rows.

    ``rules`` are counted by the write; a row that breaks one leaves the table as it was.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    ensure_schema(spark, name, root)
    before = stored_in(spark, name) if exists(spark, name) else None
    version = f"{name}_{uuid.uuid4().hex}"
    watch = Watch(df, rules)
    _writer(watch.rows, partition_by).option("path", f"{root}/{version.replace('.', '/')}").saveAsTable(version)
    try:
        watch.check()
    except QualityGateFailed:
        spark.sql(f"DROP TABLE {version}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{STORED}' = '{version}') AS SELECT * FROM {version}")
    if before:
        spark.sql(f"DROP TABLE {before}")  # external: the files stay


def ensure(spark: SparkSession, name: str, ddl: str, partition_by: tuple[str, ...], root: str) -> None:
    """Create an empty partitioned table, if it is not there."""
    root = root.rstrip("/")
    ensure_schema(spark, name, root)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) "
        f"LOCATION '{root}/{name.replace('.', '/')}'"
    )


def ensure_batches(spark: SparkSession, name: str, ddl: str, partition_by: tuple[str, ...], root: str) -> None:
    """Create an empty table whose rows come in replayable batches, if it is not there."""
    ensure(spark, name, ddl, ("batch_id", *partition_by), root)


def insert(df: DataFrame, name: str, partition_by: tuple[str, ...]) -> None:
    """Add rows to a partitioned table."""
    spark, df = df.sparkSession, cut(df)
    rows = df.select(*spark.table(name).columns).hint("rebalance", *partition_by)
    rows.write.insertInto(name)
    spark.catalog.refreshTable(name)


def write_batch(df: DataFrame, name: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Store one batch; a replay replaces what the same batch wrote before.

    The batch is cut from its inputs first, as they usually include the table.
    """
    spark, df = df.sparkSession, cut(df)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    target = ", ".join((f"batch_id = {batch_id}", *partition_by))
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({target}) SELECT * FROM {{rows}}", rows=df)


def read(spark: SparkSession, name: str) -> DataFrame:
    """All rows; filters on partition columns are answered by the catalog."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def ensure_schema(spark: SparkSession, name: str, root: str) -> None:
    if "." in name:
        schema = name.rsplit(".", 1)[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root}/{schema}.db'")


def _writer(df: DataFrame, partition_by: tuple[str, ...]):
    if partition_by:
        # Few files per partition; AQE splits a partition value that holds too much for one task.
        return df.hint("rebalance", *partition_by).write.format("parquet").partitionBy(*partition_by)
    return df.write.format("parquet")
