"""Partitioned tables in which whole partitions are replaced in one step.

The name is a view over a stored table that has one more partition column, the
version.  The view shows the versions up to the one in use.  New content of
some partitions is written under the next version, beside the old one and not
shown; then one statement replaces the view by one that shows the next version
and, of the partitions replaced, nothing older.  A reader sees all old rows or
all new ones, and a writer lost on the way leaves the old ones in place.  What it
wrote is left out of the catalog by the next writer.

After the switch the old versions leave the catalog and the view's list of
them goes, too; a writer lost there leaves that to the next one.  Files stay for
readers that still hold them; removing those is a retention job's business.

There is one writer at a time.  Partition columns are dates or integers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.operators.quality import QualityGateFailed, Watch
from omnibus.sources import tables
from omnibus.sources.shared import cut

VERSION = "_version"
_AT = "version_in_use"
_PARTS = "partitioned_by"
_REPLACED = "replaced"

#: Values of the partition columns: days counted from 1970 for dates; None for NULL.
Part = tuple[int | None, ...]


def publish(
    df: DataFrame, name: str, root: str, partition_by: tuple[str, ...], rules: dict[str, Column] | None = None
) -> None:
    """Create the table, or replace all its rows; a row that breaks one of ``rules`` leaves it as it was."""
    spark, root = df.sparkSession, root.rstrip("/")
    tables.ensure_schema(spark, name, root)
    before = _property(spark, name, tables.STORED) if tables.exists(spark, name) else None
    stored = f"{name}_{uuid.uuid4().hex}"
    watch = Watch(df, rules)
    rows = watch.rows.withColumn(VERSION, F.lit(0).cast("bigint")).hint("rebalance", *partition_by)
    path = f"{root}/{stored.replace('.', '/')}"
    rows.write.format("parquet").partitionBy(*partition_by, VERSION).option("path", path).saveAsTable(stored)
    try:
        watch.check()
    except QualityGateFailed:
        spark.sql(f"DROP TABLE {stored}")
        raise
    _show(spark, name, stored, partition_by, 0)
    if before:
        spark.sql(f"DROP TABLE {before}")  # external: the files stay


def ensure(spark: SparkSession, name: str, ddl: str, partition_by: tuple[str, ...], root: str) -> None:
    """Create an empty table, if it is not there."""
    if not tables.exists(spark, name):
        publish(spark.createDataFrame([], ddl), name, root, partition_by)


def append(df: DataFrame, name: str, rules: dict[str, Column] | None = None) -> None:
    """Add rows, or none if one breaks one of ``rules``."""
    spark, watch = df.sparkSession, Watch(df, rules)
    rows = cut(watch.rows)
    watch.check()
    _insert(rows, name, _finish(spark, name))
    spark.catalog.refreshTable(name)


def replace(df: DataFrame, name: str, parts: set[Part]) -> None:
    """Store the rows as the whole content of ``parts``, all at once; they must not fall elsewhere.

    The rows are cut from their inputs first, as they usually include the table.
    """
    if not parts:
        return
    spark, df = df.sparkSession, cut(df)
    at = _finish(spark, name)
    # A version that a lost writer began leaves the catalog and is not used again, as its files may be there.
    version = max([at, *(v for _, v in _partitions(spark, name))]) + 1
    _drop(spark, name, lambda _, v: v > at)
    _insert(df, name, version)
    _switch(spark, name, version, parts)
    _finish(spark, name)
    spark.catalog.refreshTable(name)


def parts_of(rows: DataFrame, partition_by: tuple[str, ...]) -> set[Part]:
    """The partitions that rows fall into."""
    kinds = dict(rows.select(*partition_by).dtypes)
    number = [(F.unix_date(c) if kinds[c] == "date" else F.col(c).cast("bigint")).alias(c) for c in partition_by]
    return {tuple(r) for r in rows.select(*number).distinct().collect()}  # days or buckets


def newest_day(spark: SparkSession, name: str, column: str) -> str | None:
    """The latest day of a partition column, as the catalog has it."""
    at = _in_use(spark, name)
    days = [dict(p)[column] for p, v in _partitions(spark, name) if v <= at]
    return max((d for d in days if d is not None), default=None)


def _insert(df: DataFrame, name: str, version: int) -> None:
    spark, stored = df.sparkSession, _property(df.sparkSession, name, tables.STORED)
    rows = df.withColumn(VERSION, F.lit(version).cast("bigint")).select(*spark.table(stored).columns)
    rows.hint("rebalance", *_partitioned_by(spark, name)).write.insertInto(stored)


def _switch(spark: SparkSession, name: str, version: int, parts: set[Part]) -> None:
    """The one step after which readers see the new content of ``parts``."""
    _show(spark, name, _property(spark, name, tables.STORED), _partitioned_by(spark, name), version, parts)


def _show(
    spark: SparkSession, name: str, stored: str, partition_by: tuple[str, ...], version: int, parts: set[Part] = frozenset()
) -> None:
    columns = spark.table(stored)
    shown = ", ".join(f"`{c}`" for c in columns.columns if c != VERSION)
    condition = f"{VERSION} <= {version}"
    if parts:
        kinds = dict(columns.dtypes)
        alike = " OR ".join(
            "(" + " AND ".join(f"`{c}` <=> {_literal(kinds[c], v)}" for c, v in zip(partition_by, part)) + ")"
            for part in sorted(parts, key=str)
        )
        condition += f" AND NOT ({VERSION} < {version} AND ({alike}))"
    listed = json.dumps(sorted(parts, key=str))
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{tables.STORED}' = '{stored}', '{_AT}' = '{version}', "
        f"'{_PARTS}' = '{','.join(partition_by)}', '{_REPLACED}' = '{listed}') "
        f"AS SELECT {shown} FROM {stored} WHERE {condition}"
    )


def _finish(spark: SparkSession, name: str) -> int:
    """Complete the last switch: its old versions leave the catalog and the view.  The version in use."""
    at, stored = _in_use(spark, name), _property(spark, name, tables.STORED)
    replaced = {tuple(p) for p in json.loads(_property(spark, name, _REPLACED))}
    if replaced:
        kinds, columns = dict(spark.table(stored).dtypes), _partitioned_by(spark, name)
        gone = _catalog_values(spark, [kinds[c] for c in columns], replaced)
        _drop(spark, name, lambda values, v: v < at and tuple(x for _, x in values) in gone)
        _show(spark, name, stored, columns, at)
    return at


def _drop(spark: SparkSession, name: str, wanted) -> None:
    """Take stored partitions out of the catalog; ``wanted`` gets their values and version."""
    stored = _property(spark, name, tables.STORED)
    kinds = dict(spark.table(stored).dtypes)
    specs = []
    for values, version in _partitions(spark, name):
        if wanted(values, version):
            shown = [(c, "NULL" if x is None else f"DATE'{x}'" if kinds[c] == "date" else x) for c, x in values]
            specs.append(", ".join([*(f"`{c}` = {x}" for c, x in shown), f"{VERSION} = {version}"]))
    if specs:
        spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS {', '.join(f'PARTITION ({x})' for x in specs)}")


def _partitions(spark: SparkSession, name: str) -> list[tuple[tuple[tuple[str, str | None], ...], int]]:
    """((column, value as the catalog has it), ...) and version of each stored partition."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {_property(spark, name, tables.STORED)}").collect():  # one a partition
        pairs = [p.split("=", 1) for p in row[0].split("/")]
        values = tuple((c, None if x in ("__HIVE_DEFAULT_PARTITION__", "null") else x) for c, x in pairs if c != VERSION)
        out.append((values, int(dict(pairs)[VERSION])))
    return out


def _literal(kind: str, value: int | None) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    return f"DATE_FROM_UNIX_DATE({value})" if kind == "date" else f"CAST({value} AS {kind})"


def _catalog_values(spark: SparkSession, kinds: list[str], parts: set[Part]) -> set[tuple[str | None, ...]]:
    """The values of partitions as the catalog has them."""
    rows = ", ".join("(" + ", ".join(f"CAST({_literal(k, v)} AS STRING)" for k, v in zip(kinds, part)) + ")" for part in parts)
    return {tuple(r) for r in spark.sql(f"SELECT * FROM VALUES {rows}").collect()}


def _property(spark: SparkSession, name: str, key: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{key}')").first()["value"]


def _in_use(spark: SparkSession, name: str) -> int:
    return int(_property(spark, name, _AT))


def _partitioned_by(spark: SparkSession, name: str) -> tuple[str, ...]:
    return tuple(_property(spark, name, _PARTS).split(","))
