"""The report's 50 visuals as one table of specifications.

Every visual is one grouped aggregate over a gold view or fact, evaluated as
role filter, then slicers, then the group-by.  Slicer visuals list the distinct
values to pick from.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omnibus import params
from omnibus.operators.access import Slicer, Viewer, visible
from omnibus.plans.gold import not_stopped_pings


@dataclass(frozen=True)
class Visual:
    page: str
    table: str
    by: tuple[str, ...] = ()
    # (function, column); the output column is function_column.
    measures: tuple[tuple[str, str], ...] = ()
    where: str | None = None
    top: int | None = None  # keep the groups with the largest first measure
    pick: str | None = None  # slicer visuals: the column to pick from


def _measure(function: str, column: str) -> Column:
    if function == "not_stopped":
        return not_stopped_pings().alias("not_stopped_pings")
    apply = {
        "sum": F.sum, "max": F.max, "count": F.count, "count_distinct": F.count_distinct,
        "avg": lambda c: F.avg(F.col(c).cast("double")),
    }[function]
    return apply(column).alias(f"{function}_{column}")


def _sums(*columns: str):
    return tuple(("sum", c) for c in columns)


OPS, PLANNING, DEPOT, FLEET, CUSTOMER = "operations", "planning", "depot", "fleet", "customer"
SUMMARY, TOP, HOURLY = "route_schedule_summary", "top_routes", "hourly_distribution"
ACTIVITY, PINGS = "vehicle_activity", "fact_vehicle_positions"
RAIN, IMPACT, WEATHER = "weather_summary", "weather_vs_activity", "fact_weather_daily"

VISUALS: dict[str, Visual] = {
    "v01": Visual(OPS, HOURLY, ("hour_of_day", "time_slot"), _sums("total_departures")),
    "v02": Visual(OPS, ACTIVITY, (), (("avg", "avg_speed_kmh"),)),
    "v03": Visual(OPS, SUMMARY, (), _sums("total_stop_events")),
    "v04": Visual(OPS, "fact_fuel_prices", ("date",), (("avg", "petrol_delhi_inr"), ("avg", "diesel_delhi_inr"))),
    "v05": Visual(OPS, SUMMARY, (), (("count_distinct", "route_id"),)),
    "v06": Visual(OPS, TOP, ("route_name",), _sums("scheduled_trips"), top=10),
    "v07": Visual(OPS, RAIN, ("weather_label",), _sums("total_days")),
    "v08": Visual(OPS, "dim_route", pick="route_long_name"),
    "v09": Visual(OPS, SUMMARY, (), _sums("offpeak_stops", "peak_hour_stops")),
    "v10": Visual(OPS, SUMMARY, (), _sums("total_trips")),
    "v11": Visual(
        PLANNING, "dim_trip", (),
        _sums("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"),
    ),
    "v12": Visual(PLANNING, HOURLY, ("hour_of_day",), _sums("total_departures")),
    "v13": Visual(PLANNING, SUMMARY, (), _sums("total_trips")),
    "v14": Visual(PLANNING, HOURLY, pick="time_slot"),
    "v15": Visual(PLANNING, TOP, ("route_name",), _sums("scheduled_trips"), top=20),
    "v16": Visual(PLANNING, HOURLY, ("time_slot",), (("count_distinct", "total_departures"),)),
    "v17": Visual(PLANNING, "dim_route", pick="route_long_name", where="route_long_name IS NOT NULL"),
    "v18": Visual(PLANNING, SUMMARY, (), (("avg", "peak_hour_pct"),)),
    "v19": Visual(PLANNING, SUMMARY, (), _sums("unique_stops_served")),
    "v20": Visual(
        PLANNING, SUMMARY, ("route_name",),
        _sums("total_trips", "unique_stops_served") + (("avg", "peak_hour_pct"),),
    ),
    "v21": Visual(DEPOT, ACTIVITY, (), (("avg", "avg_speed_kmh"),)),
    "v22": Visual(DEPOT, ACTIVITY, ("stopped_pings",), (("not_stopped", ""),)),
    "v23": Visual(DEPOT, "dim_route", pick="route_long_name"),
    "v24": Visual(DEPOT, ACTIVITY, ("activity_hour",), _sums("position_pings")),
    "v25": Visual(DEPOT, ACTIVITY, (), _sums("position_pings")),
    "v26": Visual(DEPOT, ACTIVITY, (), _sums("unique_vehicles")),
    "v27": Visual(DEPOT, ACTIVITY, pick="activity_hour"),
    "v28": Visual(DEPOT, ACTIVITY, ("route_name",), (("avg", "avg_speed_kmh"),)),
    "v29": Visual(DEPOT, ACTIVITY, (), (("avg", "pct_stopped"),)),
    "v30": Visual(
        DEPOT, ACTIVITY, ("route_name",),
        _sums("position_pings", "unique_vehicles") + (("avg", "avg_speed_kmh"), ("avg", "pct_stopped")),
    ),
    "v31": Visual(FLEET, PINGS, pick="speed"),
    "v32": Visual(FLEET, PINGS, (), (("count", "entity_id"),)),
    "v33": Visual(FLEET, PINGS, ("vehicle_id", "route_id", "timestamp"), (("avg", "speed"), ("sum", "status"))),
    "v34": Visual(FLEET, ACTIVITY, ("route_name",), (("count_distinct", "stopped_pings"),)),
    "v35": Visual(FLEET, PINGS, ("speed",), (("count", "vehicle_id"),), where="speed = 0"),
    "v36": Visual(FLEET, PINGS, (), (("count_distinct", "vehicle_id"),)),
    "v37": Visual(FLEET, PINGS, ("timestamp",), (("avg", "speed"),)),
    "v38": Visual(FLEET, "dim_route", pick="route_long_name"),
    "v39": Visual(FLEET, PINGS, (), (("avg", "speed"),)),
    "v40": Visual(CUSTOMER, IMPACT, ("date",), (("avg", "precipitation_mm"),)),
    "v41": Visual(CUSTOMER, "dim_date", pick="date"),
    "v42": Visual(CUSTOMER, IMPACT, ("date",), (("avg", "temp_avg_c"),)),
    "v43": Visual(CUSTOMER, RAIN, ("weather_label",), _sums("total_days")),
    "v44": Visual(
        CUSTOMER, RAIN, ("weather_label",),
        _sums("avg_rain_mm", "avg_temp_c", "avg_wind_kmh", "max_rain_mm", "rainy_days", "total_days"),
    ),
    "v45": Visual(CUSTOMER, WEATHER, (), (("count_distinct", "date"),)),
    "v46": Visual(CUSTOMER, WEATHER, (), (("max", "precipitation_mm"),)),
    "v47": Visual(CUSTOMER, IMPACT, ("date",), (("avg", "precipitation_mm"),)),
    "v48": Visual(CUSTOMER, WEATHER, (), (("avg", "temp_avg_c"),)),
    "v49": Visual(CUSTOMER, WEATHER, (), _sums("is_rainy_day")),
    "v50": Visual(CUSTOMER, WEATHER, pick="weather_label"),
}

# The order a visual is shown in; a leading minus means descending.
SORTS = {
    "v01": "-sum_total_departures", "v04": "date", "v06": "-sum_scheduled_trips", "v07": "-sum_total_days",
    "v12": "-sum_total_departures", "v15": "-sum_scheduled_trips", "v16": "-count_distinct_total_departures",
    "v20": "-sum_unique_stops_served", "v22": "-not_stopped_pings", "v24": "-sum_position_pings",
    "v28": "-avg_avg_speed_kmh", "v33": "-timestamp", "v34": "-count_distinct_stopped_pings",
    "v35": "-count_vehicle_id", "v37": "-avg_speed", "v42": "date", "v43": "-sum_total_days", "v47": "date",
}

# Slicer state the report is saved with, per page.
SAVED_SLICERS: dict[str, tuple[Slicer, ...]] = {
    PLANNING: (Slicer("dim_route", "route_long_name", "not_null"),),
    CUSTOMER: (Slicer(WEATHER, "weather_label", "in", (params.DEFAULT_LABEL_FILTER,)),),
}


def report_query(
    model: dict[str, DataFrame],
    visual_id: str,
    slicers: Iterable[Slicer] = (),
    viewer: Viewer | None = None,
    saved_state: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """One visual's rows; ``in_order`` adds the order it is shown in."""
    visual = VISUALS[visual_id]
    active = tuple(slicers) + (SAVED_SLICERS.get(visual.page, ()) if saved_state else ())
    df = visible(model, visual.table, active, viewer)
    if visual.where:
        df = df.where(visual.where)
    if visual.pick:
        return df.select(visual.pick).distinct()
    measures = [_measure(*m) for m in visual.measures]
    grouped = df.groupBy(*visual.by).agg(*measures) if visual.by else df.agg(*measures)
    shown = _largest(grouped, visual) if visual.top else grouped
    if in_order and visual_id in SORTS:
        column = SORTS[visual_id]
        shown = shown.orderBy(F.desc(column[1:]) if column.startswith("-") else F.asc(column))
    return shown


def _largest(grouped: DataFrame, visual: Visual) -> DataFrame:
    """Groups ranked within the first ``top`` values; ties stay.

    Only used over the top-routes view, which has at most 50 rows.
    """
    first = "{}_{}".format(*visual.measures[0])
    ranked = grouped.withColumn("_rank", F.rank().over(Window.orderBy(F.desc(first))))
    return ranked.where(F.col("_rank") <= visual.top).drop("_rank")
