"""Relationships, slicers and row-level security as semi-joins.

A filter on the one side of a relationship narrows the many side, through
several hops, and never travels back up.  Views that group by route are made
from the visible routes' rows only, so the filter lies below their aggregate.  Nothing here is hinted: whether a
narrowed dimension is broadcast is left to its measured size.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus.operators.skew import rekeyed

# (many side, column, one side, column)
RELATIONSHIPS = (
    ("route_schedule_summary", "route_id", "dim_route", "route_id"),
    ("vehicle_activity", "route_id", "dim_route", "route_id"),
    ("top_routes", "route_id", "dim_route", "route_id"),
    ("fact_vehicle_positions", "route_id", "dim_route", "route_id"),
    ("dim_trip", "route_id", "dim_route", "route_id"),
    ("weather_vs_activity", "date", "dim_date", "date"),
    ("fact_fuel_prices", "date", "dim_date", "date"),
    ("fact_weather_daily", "date", "dim_date", "date"),
    ("fact_schedule", "trip_id", "dim_trip", "trip_id"),
    ("fact_schedule", "stop_id", "dim_stop", "stop_id"),
)

RESTRICTED_ROLE = "Depot Manager"
OPEN_ROLES = (
    "Head of Operations Analytics",
    "Route Planning Manager",
    "Fleet & Maintenance Manager",
    "Customer Experience Head",
)


@dataclass(frozen=True)
class Slicer:
    """One predicate on a table's column."""

    table: str
    column: str
    op: str  # "in", "between" or "not_null"
    values: tuple[Any, ...] = ()

    def predicate(self) -> Column:
        c = F.col(self.column)
        if self.op == "in":
            return c.isin(*self.values)
        if self.op == "between":
            return c.between(*self.values)
        if self.op == "not_null":
            return c.isNotNull()
        raise ValueError(f"unknown slicer operation {self.op!r}")


@dataclass(frozen=True)
class Viewer:
    """Who asks; only the restricted role is narrowed."""

    role: str
    email: str | None = None

    def __post_init__(self):
        if self.role != RESTRICTED_ROLE and self.role not in OPEN_ROLES:
            raise ValueError(f"unknown role {self.role!r}")


def own_routes(access: DataFrame, email: str | None) -> DataFrame:
    """The access rows of one user; equality is case-sensitive."""
    return access.where(F.col("user_email") == F.lit(email))


def visible(
    model: dict[str, DataFrame],
    table: str,
    slicers: Iterable[Slicer] = (),
    viewer: Viewer | None = None,
) -> DataFrame:
    """A table as one viewer sees it under the given slicers."""
    slicers = tuple(slicers)
    by_route = getattr(model, "by_route", {})
    if table in by_route and _reached("dim_route", slicers, viewer):
        # dim_route is this view's only parent, so this is all that narrows it from above.
        routes = visible(model, "dim_route", slicers, viewer)
        df = by_route[table](rekeyed(routes.select("route_id"), "route_id"))
        for s in slicers:
            if s.table == table:
                df = df.where(s.predicate())
        return df
    df = model[table]
    if _restricted(viewer) and table in ("dim_route", "user_route_access"):
        allowed = own_routes(model["user_route_access"], viewer.email)
        df = allowed if table == "user_route_access" else df.join(allowed, "route_id", "left_semi")
    for s in slicers:
        if s.table == table:
            df = df.where(s.predicate())
    for many, column, one, key in RELATIONSHIPS:
        if many == table and _reached(one, slicers, viewer):
            parent = visible(model, one, slicers, viewer)
            keys = rekeyed(parent.select(F.col(key).alias(column)), column)
            df = df.join(keys, column, "left_semi")
    return df


def _restricted(viewer: Viewer | None) -> bool:
    return viewer is not None and viewer.role == RESTRICTED_ROLE


def _reached(table, slicers, viewer) -> bool:
    """Whether any filter narrows this table, itself or through its parents."""
    if table == "dim_route" and _restricted(viewer):
        return True
    if any(s.table == table for s in slicers):
        return True
    return any(_reached(one, slicers, viewer) for many, _, one, _ in RELATIONSHIPS if many == table)
