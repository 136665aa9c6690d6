import datetime as dt

import pytest
from helpers import as_set

from omnibus.operators.quality import QualityGateFailed
from omnibus.plans import gold, jobs, loads
from omnibus.schemas import FACT_POSITIONS, USER_ROUTE_ACCESS

TEXTS = {
    "routes": "route_id,route_short_name,route_long_name,route_type\nr1,,Ring,3\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon\na,A,28.5,77.1\nb,B,28.6,77.2\n",
    "trips": "trip_id,route_id,service_id,shape_id\nt1,r1,wk,s\nt2,r1,wk,s\n",
    "stop_times": "trip_id,stop_id,stop_sequence,arrival_time,departure_time\n"
                  "t1,a,1,08:00:00,08:00:00\nt1,b,2,08:30:00,08:30:00\nt2,a,1,12:00:00,12:00:00\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
                "wk,1,1,1,1,1,0,0,20240101,20241231\n",
    "agency": "agency_id,agency_name,agency_url,agency_timezone\n1,Bus,,Asia/Kolkata\n",
}


def landed(tmp_path, **changes):
    folder = tmp_path / "gtfs"
    folder.mkdir(exist_ok=True)
    for name, text in {**TEXTS, **changes}.items():
        (folder / f"{name}.txt").write_text(text)
    (tmp_path / "weather.json").write_text(
        '{"daily": {"time": ["2026-09-17"], "temperature_2m_max": [30.0], "temperature_2m_min": [20.0],'
        ' "precipitation_sum": [1.0], "windspeed_10m_max": [9.0], "weathercode": [61]}}')
    (tmp_path / "fuel.csv").write_text("date,petrol_delhi_inr,diesel_delhi_inr,source_note\n2024-01-01,90.0,80.0,s\n")
    return str(folder), str(tmp_path / "weather.json"), str(tmp_path / "fuel.csv")


def test_reload_and_materialize(spark, rows, tmp_path):
    root = str(tmp_path / "lake")
    jobs.reload_warehouse(spark, *landed(tmp_path), root, "job_silver", "job_gold")
    star = {name: spark.table(f"job_gold.{name}") for name in loads.STAR}
    star["fact_vehicle_positions"] = rows([], FACT_POSITIONS)
    star["user_route_access"] = rows([], USER_ROUTE_ACCESS)
    loads.materialize_gold(gold.build_model(star), "job_gold", root)
    summary = spark.table("job_gold.route_schedule_summary_gold")
    assert as_set(summary, "route_name", "total_trips", "total_stop_events", "peak_hour_stops") == {("Ring", 2, 3, 2)}
    weather = spark.table("job_gold.weather_vs_activity_gold")
    assert as_set(weather, "date", "weather_label", "total_pings") == {(dt.date(2026, 9, 17), "Drizzle/Rain", 0)}


def test_access_file_is_gated_and_loaded(spark, tmp_path):
    root, grants = str(tmp_path / "lake"), tmp_path / "access.csv"
    grants.write_text("user_email,route_id\ndm@x,r1\ndm@x,r1\n")
    jobs.reload_warehouse(spark, *landed(tmp_path), root, "acc_silver", "acc_gold", access=str(grants))
    assert [tuple(r) for r in spark.table("acc_gold.user_route_access").collect()] == [("dm@x", "r1")]
    grants.write_text("user_email,route_id\n,r1\n")
    with pytest.raises(QualityGateFailed, match="null user_route_access.user_email: 1"):
        jobs.reload_warehouse(spark, *landed(tmp_path), root, "acc_silver", "acc_gold", access=str(grants))


def test_failed_check_stops_before_the_star(spark, tmp_path):
    root = str(tmp_path / "lake")
    doubled = TEXTS["trips"] + "t1,r1,wk,s\n"
    with pytest.raises(QualityGateFailed, match="unique dim_trip.trip_id: 1"):
        jobs.reload_warehouse(spark, *landed(tmp_path, trips=doubled), root, "bad_silver", "bad_gold")
    assert not spark.catalog.databaseExists("bad_gold")
