"""The batch reload: landed files to silver, the quality gate, the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from omnibus.operators.quality import gate
from omnibus.plans import checks, loads, silver
from omnibus.plans.views import Views
from omnibus.session import prepare
from omnibus.sources import files, quarantine, tables

BROKEN_RECORDS = "broken_records"


def build_silver(
    spark: SparkSession, gtfs: str, weather: str, fuel: str, holidays: DataFrame | None = None
) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """The silver tables of the records that can be read, and the broken records by source."""
    landed = quarantine.read_gtfs(spark, gtfs)
    raw = {name: found.good for name, found in landed.items()}
    days, prices = quarantine.read_weather(spark, weather), quarantine.read_fuel(spark, fuel)
    silver_tables = {
        "dim_route": silver.dim_route(raw["routes"]),
        "dim_stop": silver.dim_stop(raw["stops"]),
        "dim_trip": silver.dim_trip(raw["trips"], raw["calendar"]),
        "dim_date": silver.dim_date(silver.calendar_bounds(spark), holidays),
        "fact_schedule": silver.fact_schedule(raw["stop_times"]),
        "fact_weather_daily": silver.weather_daily(days.good),
        "fact_fuel_prices": prices.good,
    }
    return silver_tables, [found.broken for found in (*landed.values(), days, prices)]


def reload_warehouse(
    spark: SparkSession, gtfs: str, weather: str, fuel: str, root: str,
    silver_schema: str = "silver", gold_schema: str = "gold", holidays: DataFrame | None = None, access: str | None = None,
) -> None:
    """Build and store silver, stop if a check fails, then replace the star tables.

    Records that cannot be read go to the quarantine table and stop nothing.
    Row-level checks of silver are counted while it is written, and stop a table
    before its new rows can be seen.

    ``access`` is the file of route grants; without it a stored access table stays as it is.
    """
    prepare(spark)
    built, broken = build_silver(spark, gtfs, weather, fuel, holidays)
    quarantine.store(broken, f"{silver_schema}.{BROKEN_RECORDS}", root)
    for name, df in built.items():
        tables.publish(df, f"{silver_schema}.{name}", root, rules=checks.row_rules(name))
    grants = {"user_route_access": files.read_access(spark, access)} if access else {}
    stored = Views({name: lambda n=name: spark.table(f"{silver_schema}.{n}") for name in loads.STAR})
    dated = {name: loads.star_columns(name, stored[name]) for name in loads.STAR}
    gate(checks.all_checks({**dated, **grants}, only={*loads.STAR, *grants}, counted=set(loads.STAR)))
    loads.load_star(stored, gold_schema, root)
    for source in grants.values():
        loads.load_access(source, gold_schema, root)
