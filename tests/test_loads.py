import datetime as dt

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from omnibus import schemas
from omnibus.plans import loads, silver
from omnibus.sources import files, tables

PINGS = schemas.FACT_POSITIONS


def pings(rows, *ingested):
    data = [
        (f"e{i}", "v", "t", "r", 28.6, 77.2, 1.0, f"2026-09-{17 + i % 3}T10:00:00+05:30", 0, when, 5.0)
        for i, when in enumerate(ingested)
    ]
    return silver.with_wall_clock(rows(data, PINGS))


def ids(spark, schema):
    return as_set(spark.table(f"{schema}.{loads.POSITIONS}"), "entity_id")


def test_incremental_load_is_strict_on_seconds(spark, rows, tmp_path):
    root = str(tmp_path)
    loads.load_positions(spark, pings(rows, "2026-09-20T10:00:00"), "inc", root)
    source = pings(rows, "2026-09-20T10:00:00", "2026-09-20T10:00:00.900", "2026-09-20 10:00:01", "late", None)
    for _ in range(2):  # the second run finds nothing new
        loads.load_positions(spark, source, "inc", root)
        assert ids(spark, "inc") == {("e0",), ("e2",)}
        assert spark.table("inc.fact_vehicle_positions").count() == 2


def test_empty_or_unparseable_target_loads_everything(spark, rows, tmp_path):
    source = pings(rows, "2026-09-20T10:00:00", "late", None)
    loads.load_positions(spark, source.limit(0), "empty", str(tmp_path))
    loads.load_positions(spark, source, "empty", str(tmp_path))
    assert spark.table("empty.fact_vehicle_positions").count() == 3
    loads.load_positions(spark, pings(rows, "late"), "junk", str(tmp_path))
    loads.load_positions(spark, source, "junk", str(tmp_path))
    assert spark.table("junk.fact_vehicle_positions").count() == 4


def test_full_reload_replaces(spark, rows, tmp_path):
    loads.load_positions(spark, pings(rows, "2026-09-20T10:00:00", "2026-09-20T11:00:00"), "full", str(tmp_path))
    loads.load_positions(spark, pings(rows, "2026-09-20T09:00:00"), "full", str(tmp_path), full_reload=True)
    assert ids(spark, "full") == {("e0",)}


def test_positions_are_partitioned_by_day(spark, rows, tmp_path):
    loads.load_positions(spark, pings(rows, "a", "b", "c", "d"), "parts", str(tmp_path))
    df = spark.table("parts.fact_vehicle_positions").where(F.col("ping_date") >= dt.date(2026, 9, 19))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ping_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_star_reload_keeps_rows_with_bad_dates(spark, rows, tmp_path):
    star = {name: spark.createDataFrame([], ddl) for name, ddl in loads.STAR.items()}
    star["dim_route"] = rows([("r", "S", "L", 3)], schemas.DIM_ROUTE)
    fuel = [("2024-01-01", 90.0, 80.0, "s"), ("soon", 91.0, 81.0, "s")]
    star["fact_fuel_prices"] = rows(fuel, "date string, petrol_delhi_inr double, diesel_delhi_inr double, source_note string")
    for _ in range(2):
        loads.load_star(star, "star", str(tmp_path))
    assert as_set(spark.table("star.fact_fuel_prices"), "date", "petrol_delhi_inr") == {
        (dt.date(2024, 1, 1), 90.0), (None, 91.0),
    }
    assert spark.table("star.dim_route").count() == 1
    assert spark.table("star.fact_schedule").schema.simpleString().startswith("struct<trip_id:string,stop_id:string")


def test_failed_reload_leaves_the_table(spark, rows, tmp_path):
    tables.publish(rows([(1,)], "x int"), "safe.t", str(tmp_path))
    broken = rows([("a",)], "y string").select(F.col("y").cast("int").alias("x"))
    with pytest.raises(Exception):
        tables.publish(broken, "safe.t", str(tmp_path))
    assert as_set(spark.table("safe.t")) == {(1,)}


def test_gtfs_scan_matches_columns_by_name(spark, tmp_path):
    texts = {
        "routes": 'route_type,route_id,route_short_name,route_long_name,route_color\n3,7,,"Ring, outer",FFF\n',
        "stops": "stop_id,stop_name,stop_lat,stop_lon\na,A,28.5,77.1\n",
        "trips": "trip_id,route_id,service_id\nt,7,wk\n",
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt,25:10:00,25:11:00,a,1\n",
        "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
                    "wk,1,1,1,1,1,0,0,20240101,20241231\n",
        "agency": "agency_id,agency_name,agency_url,agency_timezone\n1,Bus,,Asia/Kolkata\n",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    raw = files.read_gtfs(spark, str(tmp_path))
    assert as_set(silver.dim_route(raw["routes"])) == {("7", None, "Ring, outer", 3)}
    assert as_set(silver.dim_trip(raw["trips"], raw["calendar"]), "trip_id", "shape_id", "monday") == {("t", None, 1)}
    assert silver.fact_schedule(raw["stop_times"]).first()["departure_hour"] == 25


def test_weather_document(spark, tmp_path):
    (tmp_path / "w.json").write_text("""{
      "daily": {"time": ["2026-09-17", "2026-09-18"], "temperature_2m_max": [30.0, 31.0],
        "temperature_2m_min": [20.0, null], "precipitation_sum": [0.0, 2.5],
        "windspeed_10m_max": [9.0, 8.0], "weathercode": [0, 61]}}""")
    out = silver.weather_daily(files.read_weather(spark, str(tmp_path)))
    assert as_set(out, "date", "temp_avg_c", "weather_label", "is_rainy_day") == {
        ("2026-09-17", 25.0, "Clear", 0), ("2026-09-18", None, "Drizzle/Rain", 1),
    }
