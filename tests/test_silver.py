import datetime as dt
import math
import random

import pytest
from helpers import as_dict, as_set
from pyspark.sql import functions as F

from omnibus import params
from omnibus.operators.asof import last_before
from omnibus.operators.dedupe import keep_first, keep_last
from omnibus.plans import silver
from omnibus.schemas import BRONZE_POSITIONS

CALENDAR = "service_id string, " + ", ".join(f"{d} string" for d in params.WEEKDAYS) + ", start_date string, end_date string"


def ping(entity, vehicle, at, lat=28.6, lon=77.2, ingested="2026-09-20T00:00:00"):
    return (entity, vehicle, "t", "r", lat, lon, 1.0, at, 0, ingested)


def test_dimensions(rows):
    routes = rows([("1", None, "L", "3"), ("1", None, "L", "3"), ("2", "S", "M", "bus")],
                  "route_id string, route_short_name string, route_long_name string, route_type string")
    assert as_set(silver.dim_route(routes)) == {("1", None, "L", 3), ("2", "S", "M", None)}
    stops = rows([("a", "A", "28.5", ""), ("b", "B", "x", "77.1")],
                 "stop_id string, stop_name string, stop_lat string, stop_lon string")
    assert as_set(silver.dim_stop(stops)) == {("a", "A", 28.5, None), ("b", "B", None, 77.1)}
    trips = rows([("t1", "1", "wk", None), ("t2", "1", "none", None)],
                 "trip_id string, route_id string, service_id string, shape_id string")
    calendar = rows([("wk", *"1111100", "20240101", "20241231")], CALENDAR)
    out = as_dict(silver.dim_trip(trips, calendar), "trip_id")
    assert (out["t1"]["friday"], out["t1"]["saturday"], out["t1"]["end_date"]) == (1, 0, "20241231")
    assert out["t2"]["monday"] is None


def test_calendar(spark, rows):
    holidays = rows([(dt.date(2024, 1, 26),), (dt.date(2024, 1, 26),)], "date date")
    days = silver.dim_date(silver.calendar_bounds(spark), holidays)
    assert days.count() == (params.CALENDAR_END - params.CALENDAR_START).days + 1
    day = as_dict(days.where("date = '2024-01-26'"), "date_key")[20240126]
    assert (day["is_public_holiday"], day["month_name"], day["day_name"], day["day_of_week"]) == (1, "January", "Friday", 6)
    assert days.where("date_key = 20240128").first()["is_weekend"] == 1
    iso = silver.dim_date(silver.calendar_bounds(spark), iso_weekday=True)
    assert iso.where("date_key = 20240126").first()["day_of_week"] == 5


def test_schedule_features(rows):
    times = rows([("t", "a", "1", "06:59:00", "07:00:00"), ("t", "b", "x", "", "26:00:00"), ("t", "c", "3", None, "junk")],
                 "trip_id string, stop_id string, stop_sequence string, arrival_time string, departure_time string")
    out = as_dict(silver.fact_schedule(times), "stop_id")
    assert (out["a"]["arrival_secs"], out["a"]["departure_hour"], out["a"]["is_peak_hour"]) == (25140, 7, 1)
    assert (out["b"]["stop_sequence"], out["b"]["arrival_secs"], out["b"]["departure_hour"]) == (None, None, 26)
    assert (out["c"]["departure_secs"], out["c"]["is_peak_hour"]) == (None, 0)


def test_weather_features(rows):
    raw = rows([("2026-09-17", 30.0, 20.0, 0.0, 5.0, 0), ("2026-09-18", 30.0, 21.0, 0.1, 5.0, 61)],
               "date string, temp_max_c double, temp_min_c double, precipitation_mm double, windspeed_max_kmh double, weather_code int")
    out = as_dict(silver.weather_daily(raw), "date")
    assert (out["2026-09-17"]["temp_avg_c"], out["2026-09-17"]["is_rainy_day"]) == (25.0, 0)
    assert (out["2026-09-18"]["weather_label"], out["2026-09-18"]["is_rainy_day"]) == ("Drizzle/Rain", 1)


def test_keep_first_and_last_are_deterministic(rows):
    df = rows([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "n")], "k string, o int, v string")
    assert as_set(keep_first(df, ["k"], ["o"])) == {("k", 1, "a"), (None, 5, "n")}
    assert as_set(keep_last(df, ["k"], ["o"])) == {("k", 2, "b"), (None, 5, "n")}


def test_position_rules(rows):
    at = "2026-09-20T{}+05:30".format
    bronze = rows(
        [
            ping("e1", "v1", at("10:00:00")),
            ping("e1b", "v1", at("10:00:00"), lat=28.9, ingested="2026-09-20T00:10:00"),  # later copy
            ping("e2", "v1", at("10:10:00"), lat=28.61),
            ping("e3", "v1", at("10:11:00"), lat=28.99),       # a jump: far over the limit
            ping("e4", "v1", at("10:20:00"), lat=0.0, lon=0.0),  # glitch
            ping("e5", "v1", at("10:30:00"), lat=None),
            ping("e6", "v2", at("10:30:00")),
            ping("e7", "v2", "2026-09-20T05:00:00+00:00"),      # the same instant in another offset
            ping("e8", "v2", "junk"),
        ],
        BRONZE_POSITIONS,
    )
    out = as_dict(silver.vehicle_positions(bronze), "entity_id")
    assert set(out) == {"e1", "e2", "e3", "e6", "e7", "e8"}
    assert out["e1"]["derived_speed_kmh"] is None
    assert out["e2"]["derived_speed_kmh"] == pytest.approx(111.195 * 0.01 * 6, rel=1e-3)
    assert out["e3"]["derived_speed_kmh"] is None
    assert {out["e6"]["derived_speed_kmh"], out["e7"]["derived_speed_kmh"], out["e8"]["derived_speed_kmh"]} == {None}
    assert out["e1"]["ping_date"] == dt.date(2026, 9, 20) and out["e1"]["ping_hour"] == 10
    assert out["e8"]["ping_date"] is None


@pytest.mark.parametrize("bucket", [60, 3600, 86_400, 10**9])
def test_last_before_equals_a_plain_walk(rows, bucket):
    rng = random.Random(bucket)
    start = dt.datetime(2026, 1, 1)
    data, seen = [], set()
    for i in range(400):
        key = rng.choice(["hot"] * 6 + ["a", "b"])
        at = start + dt.timedelta(seconds=rng.randrange(20 * 86_400))
        if (key, at) in seen:
            continue
        seen.add((key, at))
        data.append((i, key, at, rng.choice([None, i])))
    df = rows(data, "id int, k string, at timestamp, v int")
    out = {r["id"]: r["p"] for r in last_before(df, "k", "at", F.col("v"), "p", bucket_seconds=bucket).collect()}
    last, want = {}, {}
    for i, key, at, v in sorted(data, key=lambda r: r[2]):
        want[i] = last.get(key)
        if v is not None:
            last[key] = v
    assert out == want


def test_speed_over_day_edges_equals_a_plain_walk(rows):
    rng = random.Random(3)
    data, t = [], dt.datetime(2026, 9, 1)
    for i in range(200):
        t += dt.timedelta(minutes=rng.choice([5, 10, 400, 3000]))
        data.append(ping(f"e{i}", "v", t.strftime("%Y-%m-%dT%H:%M:%S+05:30"),
                         28.5 + rng.random() / 10, 77.0 + rng.random() / 10))
    out = as_dict(silver.with_speed(rows(data, BRONZE_POSITIONS), limit=None), "entity_id")
    assert out["e0"]["derived_speed_kmh"] is None
    for prev, here in zip(data, data[1:]):
        a, b, c, d = map(math.radians, (prev[4], prev[5], here[4], here[5]))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        hours = (dt.datetime.fromisoformat(here[7]) - dt.datetime.fromisoformat(prev[7])).total_seconds() / 3600
        km = 2 * params.EARTH_RADIUS_KM * math.asin(math.sqrt(h))
        assert out[here[0]]["derived_speed_kmh"] == pytest.approx(km / hours)


def test_observation_typing(rows):
    raw = rows([("7", "", "", "OTHER", "LOW", "NEW", "", "28.5", "", "2026-08-30 18:30:00", "bad"), ("x",) + ("",) * 10],
               ", ".join(f"{c} string" for c in params.EXPORT_COLUMNS))
    first, second = silver.typed_observations(raw).collect()
    assert (first["id"], first["latitude"], first["longitude"], first["created_at"]) == (7, 28.5, None, None)
    assert first["observed_at"] == dt.datetime(2026, 8, 30, 18, 30) and first["route_id"] == ""
    assert second["id"] is None and second["ingested_at"] is not None


def test_repeated_service_multiplies_no_trips(rows):
    trips = rows([("t1", "r1", "wk", "s"), ("t2", "r1", "none", "s")], "trip_id string, route_id string, service_id string, shape_id string")
    week = ("1", "1", "1", "1", "1", "0", "0")
    ddl = "service_id string, monday string, tuesday string, wednesday string, thursday string, friday string, saturday string, sunday string, start_date string, end_date string"
    calendar = rows([("wk", *week, "20240101", "20241231")] * 2, ddl)
    got = silver.dim_trip(trips, calendar).collect()
    assert sorted((r.trip_id, r.monday) for r in got) == [("t1", 1), ("t2", None)]
