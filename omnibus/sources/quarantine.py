"""Landed files read permissively: records that cannot be read go to a quarantine table, the others load.

A record is broken where a text line has more or fewer fields than the header,
a typed field does not hold its type, or a JSON document does not parse.  It is
kept as it stands in its file, with the file's name.  A line break inside quotes
is part of a record where the format allows it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus import schemas
from omnibus.sources import files, tables

_BROKEN = "_corrupt_record"
BROKEN = "source string, file string, record string"
_KEYS = ["source", "file", "record"]


@dataclass(frozen=True)
class Landed:
    """The records of a source that can be read, and ``BROKEN`` rows of the others."""

    good: DataFrame
    broken: DataFrame


def _landed(df: DataFrame, source: str) -> Landed:
    # True of every row: a scan looks only at fields that are asked for, and may not ask for broken records alone.
    fields = [F.col(f"`{c}`").cast("string") for c in df.columns if c != _BROKEN]
    read = F.length(F.concat_ws("", *fields)) >= 0
    broken = df.withColumn("_file", F.col("_metadata.file_path")).where(F.col(_BROKEN).isNotNull() & read).select(
        F.lit(source).alias("source"), F.col("_file").alias("file"), F.col(_BROKEN).alias("record")
    )
    return Landed(df.where(F.col(_BROKEN).isNull() & read).drop(_BROKEN), broken)


def read_csv(spark: SparkSession, path: str, source: str, ddl: str | None = None, **options) -> Landed:
    """Lines of text files with a header; the header's columns, as text, without ``ddl``."""
    if ddl is None:
        named = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', **options).columns
        ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in named)
    # A scan that leaves columns out would not count a line's fields.
    reader = spark.read.schema(f"{ddl}, {_BROKEN} string").option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", False)
    return _landed(reader.csv(path, header=True, mode="PERMISSIVE", quote='"', escape='"', **options), source)


def read_json(spark: SparkSession, path: str, source: str, ddl: str, one_per_line: bool = False) -> Landed:
    reader = spark.read.schema(f"{ddl}, {_BROKEN} string").option("columnNameOfCorruptRecord", _BROKEN)
    return _landed(reader.json(path, mode="PERMISSIVE", multiLine=not one_per_line), source)


def read_gtfs(spark: SparkSession, folder: str) -> dict[str, Landed]:
    """The schedule files, with the columns of ``files.read_gtfs``."""
    out = {}
    for name, ddl in schemas.GTFS_FILES.items():
        landed = read_csv(spark, f"{folder}/{name}.txt", name)
        out[name] = Landed(files.chosen_columns(landed.good, ddl), landed.broken)
    return out


def read_weather(spark: SparkSession, path: str, one_per_line: bool = False) -> Landed:
    landed = read_json(spark, path, "weather", schemas.WEATHER_DOCUMENT, one_per_line)
    return Landed(files.weather_days(landed.good), landed.broken)


def read_fuel(spark: SparkSession, path: str) -> Landed:
    return read_csv(spark, path, "fuel", schemas.FUEL_CSV)


def read_observations(spark: SparkSession, path: str) -> Landed:
    landed = read_csv(spark, path, "observations", multiLine=True)
    return Landed(landed.good.fillna(""), landed.broken)


def store(broken: list[DataFrame], name: str, root: str) -> None:
    """Add the broken records to the quarantine table, with the number of their copies in a file.

    A file that is read again adds nothing.
    """
    found = reduce(DataFrame.unionByName, broken).groupBy(*_KEYS).agg(F.count("*").alias("copies"))
    spark = found.sparkSession
    tables.ensure(spark, name, f"{BROKEN}, copies bigint", ("source",), root)
    held = tables.read(spark, name)
    same: Column = reduce(Column.__and__, [found[c].eqNullSafe(held[c]) for c in _KEYS])
    tables.insert(found.join(held, same, "left_anti"), name, ("source",))


def counts(spark: SparkSession, name: str) -> DataFrame:
    """Broken records by source and file."""
    return tables.read(spark, name).groupBy("source", "file").agg(F.sum("copies").alias("n_broken"))
