"""The checks that gate a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus import params
from omnibus.functions import geo
from omnibus.operators import quality as q
from omnibus.plans.gold import STAR_TABLES
from omnibus.plans.silver import with_wall_clock
from omnibus.schemas import LENGTHS


Rules = dict[str, dict[str, Column]]  # table -> check -> condition of a violating row

REQUIRED = {
    "dim_route": ["route_id"], "dim_stop": ["stop_id"], "dim_trip": ["trip_id"],
    "dim_date": ["date_key"], "user_route_access": ["user_email", "route_id"],
}
KEYS = {"dim_route": "route_id", "dim_stop": "stop_id", "dim_trip": "trip_id", "dim_date": "date"}
PINGS, OBSERVATIONS = "fact_vehicle_positions", "observations"


def _otherwise(condition: Column) -> Column:
    """Not true: false or NULL."""
    return ~F.coalesce(condition, F.lit(False))


def _speed_rules() -> Rules:
    return {PINGS: {"speed bound": F.col("derived_speed_kmh") > params.MAX_SPEED_KMH}}


def _box_rules(lat_range, lon_range) -> Rules:
    inside = geo.in_box(F.col("latitude"), F.col("longitude"), lat_range, lon_range)
    return {PINGS: {"ping outside box": _otherwise(inside)}}


def _null_rules() -> Rules:
    return {t: {f"null {t}.{c}": F.col(c).isNull() for c in cols} for t, cols in REQUIRED.items()}


def _domain_rules() -> Rules:
    limits = {**LENGTHS, OBSERVATIONS: {"description": 1000}}
    rules = {
        t: {f"length {t}.{c}": F.length(c) > n for c, n in columns.items()} for t, columns in limits.items()
    }
    known = {
        "problem_type": params.PROBLEM_TYPES, "severity": params.SEVERITIES, "status": params.STATUSES,
    }
    rules[OBSERVATIONS] |= {f"domain {c}": _otherwise(F.col(c).isin(*v)) for c, v in known.items()}
    return rules


def _count(model: dict[str, DataFrame], *groups: Rules, only: set[str] | None = None) -> list[DataFrame]:
    """Row rules of any number of groups, in one scan per table."""
    merged: Rules = {}
    for rules in groups:
        for table, checks in rules.items():
            if only is None or table in only:
                merged.setdefault(table, {}).update(checks)
    return [q.count_rows(model[table], checks) for table, checks in merged.items()]


def row_rules(table: str) -> dict[str, Column]:
    """The row-level checks of a star table, to be counted while it is written."""
    return {name: bad for rules in (_null_rules(), _domain_rules()) for name, bad in rules.get(table, {}).items()}


def ping_row_rules(lat_range=params.BOX_LAT, lon_range=params.BOX_LON) -> dict[str, Column]:
    """Speed bound and box of new pings."""
    return _speed_rules()[PINGS] | _box_rules(lat_range, lon_range)[PINGS]


def speed_bound(positions: DataFrame) -> DataFrame:
    return q.together(_count({PINGS: positions}, _speed_rules()))


def not_null(model: dict[str, DataFrame]) -> DataFrame:
    return q.together(_count(model, _null_rules()))


def _unique(model: dict[str, DataFrame], only: set[str]) -> list[DataFrame]:
    return [q.unique_key(f"unique {t}.{c}", model[t], [c]) for t, c in KEYS.items() if t in only]


def unique_keys(model: dict[str, DataFrame]) -> DataFrame:
    return q.together(_unique(model, set(KEYS)))


def orphan_facts(model: dict[str, DataFrame], only: set[str] = frozenset(STAR_TABLES)) -> DataFrame:
    return q.together(q.relationship_orphans(model, only))


def unique_pings(positions: DataFrame) -> DataFrame:
    return q.unique_key("unique ping", positions, ["vehicle_id", "timestamp"])


def position_rules(positions: DataFrame, lat_range=params.BOX_LAT, lon_range=params.BOX_LON) -> DataFrame:
    return q.together([*_count({PINGS: positions}, _box_rules(lat_range, lon_range)), unique_pings(positions)])


def ping_rules(positions: DataFrame, lat_range=params.BOX_LAT, lon_range=params.BOX_LON) -> DataFrame:
    """Speed bound, box and key of new pings; what a realtime load is gated by."""
    row_level = _count({PINGS: positions}, _speed_rules(), _box_rules(lat_range, lon_range))
    return q.together([*row_level, unique_pings(positions)])


def domains(model: dict[str, DataFrame], observations: DataFrame) -> DataFrame:
    """Text lengths of the star tables; closed value lists of the observations."""
    tables = {**{t: model[t] for t in LENGTHS}, OBSERVATIONS: observations}
    return q.together(_count(tables, _domain_rules()))


def calendar_cover(model: dict[str, DataFrame], only: set[str] = frozenset(STAR_TABLES)) -> DataFrame:
    """Fact dates that the calendar does not reach."""
    found = []
    for table in (PINGS, "fact_weather_daily", "fact_fuel_prices"):
        if table in only:
            facts = model[table]
            if table == PINGS:
                facts = facts if "ping_date" in facts.columns else with_wall_clock(facts)
                facts = facts.withColumn("date", F.col("ping_date"))
            found.append(q.orphans(f"calendar {table}", facts, "date", model["dim_date"], "date"))
    return q.together(found)


def all_checks(
    model: dict[str, DataFrame],
    observations: DataFrame | None = None,
    only: set[str] = frozenset(STAR_TABLES),
    lat_range=params.BOX_LAT,
    lon_range=params.BOX_LON,
    counted: set[str] = frozenset(),
) -> DataFrame:
    """Every check of the chosen tables; the row-level ones of a table share one scan.

    Those of the tables ``counted`` are left out, as their write has counted them.
    """
    tables = {t: model[t] for t in only}
    if observations is not None:
        tables[OBSERVATIONS] = observations
    row_level = _count(
        tables, _speed_rules(), _box_rules(lat_range, lon_range), _null_rules(), _domain_rules(),
        only=set(tables) - set(counted),
    )
    pings = [unique_pings(tables[PINGS])] if PINGS in only else []
    return q.together([
        *row_level, *_unique(tables, only), *pings, orphan_facts(tables, only), calendar_cover(tables, only),
    ])
