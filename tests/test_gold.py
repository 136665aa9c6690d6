import datetime as dt
from decimal import Decimal

from helpers import as_dict, as_set

from omnibus.plans import gold, questions

SCHEDULE = "trip_id string, stop_id string, departure_hour int, is_peak_hour int"
TRIPS = "trip_id string, route_id string"
ROUTES = "route_id string, route_short_name string, route_long_name string"
PINGS = "vehicle_id string, route_id string, timestamp string, derived_speed_kmh double"
WEATHER = (
    "date date, weather_label string, is_rainy_day int, precipitation_mm double, temp_avg_c double, "
    "windspeed_max_kmh double"
)


def network(rows):
    schedule = rows(
        [
            ("t1", "a", 8, 1), ("t1", "b", 8, 1), ("t1", "a", 12, 0), ("t1", None, 12, None),
            ("t2", "a", 12, 0),
            ("lost", "a", 8, 1),      # no such trip
            ("t3", "a", 8, 1),        # trip without a route
            ("t4", "c", 8, None),     # route r3, NULL flag only
        ],
        SCHEDULE,
    )
    trips = rows([("t1", "r1"), ("t2", "r2"), ("t3", None), ("t4", "r3"), ("t5", "r1")], TRIPS)
    routes = rows([("r1", None, "Long 1"), ("r2", "", "Long 2"), ("r3", "S3", "Long 3"), ("r9", "S9", "x")], ROUTES)
    return schedule, trips, routes


def test_route_summary_null_and_empty_rules(rows):
    out = as_dict(gold.route_schedule_summary(*network(rows)), "route_id")
    assert set(out) == {"r1", "r2", "r3"}
    r1 = out["r1"]
    assert r1["route_name"] == "Long 1" and out["r2"]["route_name"] == ""
    assert (r1["total_trips"], r1["total_stop_events"], r1["peak_hour_stops"], r1["offpeak_stops"]) == (1, 4, 2, 1)
    assert r1["peak_hour_pct"] == Decimal("50.0") and r1["unique_stops_served"] == 2
    r3 = out["r3"]
    assert (r3["peak_hour_stops"], r3["offpeak_stops"], r3["peak_hour_pct"]) == (None, 0, None)


def test_route_summary_types(rows):
    types = dict(gold.route_schedule_summary(*network(rows)).dtypes)
    assert types["peak_hour_pct"] == "decimal(5,1)" and types["total_stop_events"] == "bigint"


def test_repeated_route_key_multiplies_like_a_join(rows, spark):
    schedule, trips, routes = network(rows)
    routes = routes.unionByName(rows([("r1", None, "Long 1"), ("r1", "other", "Long 1")], ROUTES))
    for name, df in {"s": schedule, "t": trips, "r": routes}.items():
        df.createOrReplaceTempView(name)
    plain = spark.sql("""
        SELECT r.route_id, coalesce(route_short_name, route_long_name), count(DISTINCT t.trip_id), count(s.trip_id),
               sum(is_peak_hour), sum(CASE WHEN is_peak_hour = 0 THEN 1 ELSE 0 END), count(DISTINCT s.stop_id)
        FROM s JOIN t ON s.trip_id = t.trip_id JOIN r ON t.route_id = r.route_id
        GROUP BY r.route_id, route_short_name, route_long_name""")
    ours = gold.route_schedule_summary(schedule, trips, routes).drop("peak_hour_pct")
    assert as_set(ours) == as_set(plain)


def test_top_routes_tie_break_and_limit(rows):
    schedule = rows([(f"t{i}", "a", 8, 1) for i in range(60)], SCHEDULE)
    trips = rows([(f"t{i}", f"r{i:02d}") for i in range(60)], TRIPS)
    routes = rows([(f"r{i:02d}", f"s{i}", "l") for i in range(60)], ROUTES)
    out = [r["route_id"] for r in gold.top_routes(schedule, trips, routes).collect()]
    assert out == [f"r{i:02d}" for i in range(50)]


def test_top_routes_counts_stop_ids(rows):
    out = as_dict(gold.top_routes(*network(rows)), "route_id")
    assert out["r1"]["total_stop_events"] == 3  # the NULL stop is not counted


def test_hourly_null_hour_is_a_group(rows):
    schedule = rows([("t1", "a", None, None), ("t1", "a", 24, 0), ("t2", "a", 8, 1), ("t3", "b", 8, 1)], SCHEDULE)
    out = as_dict(gold.hourly_distribution(schedule), "hour_of_day")
    assert out[None]["time_slot"] == "Early Morning" and out[None]["is_peak_hour"] is None
    assert out[24]["time_slot"] == "Early Morning"
    assert (out[8]["total_departures"], out[8]["unique_trips"], out[8]["is_peak_hour"]) == (2, 2, 2)


def pings(rows):
    at = "2026-09-17T07:{:02d}:00+05:30".format
    speeds = [1.99, 2.0, 2.01, 120.0, 120.01, None]
    data = [("v1", "r1", at(i), s) for i, s in enumerate(speeds)]
    data += [
        ("v2", None, at(10), 10.0), ("v2", "zzz", at(11), 10.0),
        ("v1", "r1", "2026-09-16T23:59:59+05:30", 50.0),
    ]
    return rows(data, PINGS)


def test_vehicle_activity_bands_cutoff_and_unknown_routes(rows):
    routes = rows([("r1", "S", "Long 1")], ROUTES)
    out = as_dict(gold.vehicle_activity(pings(rows), routes), "route_id")
    r1 = out["r1"]
    assert r1["activity_hour"] == 7 and r1["activity_date"] == dt.date(2026, 9, 17)
    assert (r1["position_pings"], r1["stopped_pings"], r1["pct_stopped"]) == (6, 1, 16.7)
    assert r1["avg_speed_kmh"] == 61.01  # (2.01 + 120) / 2, half up
    assert out[None]["route_name"] is None and out["zzz"]["route_name"] is None


def test_vehicle_activity_repeated_route_rows(rows, spark):
    routes = rows([("r1", "S", "Long 1"), ("r1", "T", "Long 1"), ("r1", "T", "Other")], ROUTES)
    out = gold.vehicle_activity(pings(rows), routes).where("route_id = 'r1'")
    assert as_set(out, "route_name", "position_pings", "unique_vehicles", "stopped_pings", "pct_stopped") == {
        ("Long 1", 12, 1, 2, 16.7), ("Other", 6, 1, 1, 16.7),
    }


def test_weather_views(rows):
    d1, d2 = dt.date(2026, 9, 17), dt.date(2026, 9, 18)
    weather = rows(
        [(d1, "Clear", 0, 0.0, 30.0, 5.0), (d2, None, 1, 7.25, 25.5, 8.0)], WEATHER
    )
    out = as_dict(gold.weather_vs_activity(weather, pings(rows)), "date")
    assert (out[d1]["total_pings"], out[d1]["active_buses"], out[d1]["stopped_pings"]) == (8, 2, 1)
    assert out[d1]["pct_stopped"] == 12.5
    empty = out[d2]
    assert (empty["total_pings"], empty["active_buses"], empty["stopped_pings"]) == (0, 0, 0)
    assert empty["pct_stopped"] == 0.0 and empty["avg_speed_kmh"] is None
    summary = as_dict(gold.weather_summary(weather), "weather_label")
    assert summary[None]["rainy_days"] == 1 and summary["Clear"]["total_days"] == 1


def test_not_stopped_measure(rows):
    routes = rows([("r1", "S", "Long 1")], ROUTES)
    df = gold.vehicle_activity(pings(rows), routes)
    assert df.agg(gold.not_stopped_pings()).first()[0] == 7


def test_coverage_rank_keeps_ties(rows):
    df = rows([("a", "A", 5), ("b", "B", 7), ("c", "C", 5), ("d", "D", 1), ("e", "E", None)],
              "route_id string, route_name string, unique_stops_served long")
    out = as_set(questions.route_coverage(df), "route_id", "coverage_rank")
    assert out == {("b", 1), ("a", 2), ("c", 2), ("d", 4), ("e", 5)}


def test_fuel_baseline_is_first_month(rows):
    fuel = rows([(dt.date(2024, 2, 1), 99.0, 88.0), (dt.date(2024, 1, 1), 90.0, 80.0), (None, 1.0, 1.0)],
                "date date, petrol_delhi_inr double, diesel_delhi_inr double")
    out = as_dict(questions.fuel_against_baseline(fuel), "date")
    assert out[dt.date(2024, 2, 1)]["petrol_ratio"] == 1.1 and out[dt.date(2024, 1, 1)]["diesel_ratio"] == 1.0
