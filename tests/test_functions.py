import datetime as dt

import pytest
from pyspark.sql import functions as F

from omnibus import params
from omnibus.functions import clock, geo, measures


def values(spark, data, ddl, column):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], f"x {ddl}").select(column(F.col("x"))).collect()]


def test_gtfs_seconds_past_midnight_and_junk(spark):
    text = ["00:00:00", "23:59:59", "24:00:00", "25:10:00", " 7:05:09 ", "", "soon", "1:2", "07:61:00", None]
    assert values(spark, text, "string", clock.gtfs_seconds) == [
        0, 86399, 86400, 90600, 25509, None, None, None, None, None,
    ]


@pytest.mark.parametrize("wrap,expected", [(False, [0, 23, 24, 25, None]), (True, [0, 23, 0, 1, None])])
def test_service_hour(spark, wrap, expected):
    seconds = [0, 86399, 86400, 90600, None]
    assert values(spark, seconds, "int", lambda c: clock.service_hour(c, wrap)) == expected


def test_slots_and_peak_flag(spark):
    hours = [6, 7, 9, 10, 16, 17, 19, 20, 23, 24, 26, None]
    assert values(spark, hours, "int", clock.time_slot) == [
        "Early Morning", "Morning Peak", "Morning Peak", "Mid-day", "Mid-day", "Evening Peak", "Evening Peak",
        "Night", "Night", "Early Morning", "Early Morning", "Early Morning",
    ]
    assert values(spark, hours, "int", clock.peak_flag) == [0, 1, 1, 0, 0, 1, 1, 0, 0, 0, 0, 0]


def test_offset_strings(spark):
    text = ["2026-09-20T07:30:00+05:30", "junk", None]
    utc = values(spark, text, "string", lambda c: F.date_format(clock.instant(c), "HH:mm"))
    assert utc == ["02:00", None, None]
    assert values(spark, text, "string", lambda c: clock.wall_hour(c, strict=False)) == [7, None, None]
    assert values(spark, text[:1], "string", clock.wall_date) == [dt.date(2026, 9, 20)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, text, "string", clock.wall_date)


def test_ingest_second_forms(spark):
    text = ["2026-09-20T07:30:00.123+05:30", "2026-09-20 07:30:01", "late", "", None]
    assert values(spark, text, "string", clock.ingest_second) == [
        dt.datetime(2026, 9, 20, 7, 30), dt.datetime(2026, 9, 20, 7, 30, 1), None, None, None,
    ]


def test_haversine_one_degree_of_latitude(spark):
    df = spark.createDataFrame([(28.0, 77.0, 29.0, 77.0)], "a double, b double, c double, d double")
    km = df.select(geo.haversine_km(*[F.col(c) for c in "abcd"])).first()[0]
    assert km == pytest.approx(111.195, abs=0.001)


def test_box_corners_and_nulls(spark):
    lo, hi = params.BOX_LAT[0], params.BOX_LON[1]
    df = spark.createDataFrame([(lo, hi), (0.0, 0.0), (None, hi), (lo - 0.001, hi)], "lat double, lon double")
    kept = df.where(geo.in_box(F.col("lat"), F.col("lon"))).collect()
    assert [tuple(r) for r in kept] == [(lo, hi)]


def test_clamp_keeps_the_limit(spark):
    assert values(spark, [119.9, 120.0, 120.01, None], "double", geo.clamp_speed) == [119.9, 120.0, None, None]


def test_bands(spark):
    speeds = [1.99, 2.0, 2.01, 120.0, 120.01, None]
    assert values(spark, speeds, "double", measures.is_stopped) == [True, False, False, False, False, None]
    assert values(spark, speeds, "double", measures.moving_speed) == [None, None, 2.01, 120.0, None, None]


def test_labels_and_display(spark):
    assert values(spark, ["BUS_DELAY", "OTHER"], "string", measures.code_title) == ["Bus Delay", "Other"]
    assert values(spark, [0, 61, 96, 44, None], "int", measures.weather_label) == [
        "Clear", "Drizzle/Rain", "Thunderstorm", None, None,
    ]
    utc = [dt.datetime(2026, 8, 30, 20, 0)]
    assert values(spark, utc, "timestamp", clock.local_display) == ["31 Aug, 01:30"]
