import datetime as dt

from pyspark.sql import functions as F
from test_streaming import write_snapshots

from omnibus.plans import activity, gold, loads
from omnibus.plans.analogs import Analogs
from omnibus.sources import tables, versioned
from omnibus.streaming import positions as realtime

SF = "/root/testdata/sf0.001"
START = dt.date(2020, 1, 1)


def same_views(spark, schema, routes, weather):
    pings, kept = tables.read(spark, f"{schema}.{loads.POSITIONS}"), tables.read(spark, f"{schema}.{activity.PARTIALS}")
    shown = lambda df: sorted(map(str, df.collect()))
    full = gold.vehicle_activity(pings, routes, START)
    assert shown(activity.vehicle_activity(kept, routes, START).select(*full.columns)) == shown(full) and full.count() > 10
    full = gold.weather_vs_activity(weather, pings)
    assert shown(activity.weather_vs_activity(weather, kept).select(*full.columns)) == shown(full) and full.count() > 10


def test_views_equal_the_full_ones_after_late_and_corrected_pings(spark, tmp_path):
    a = Analogs(spark, SF)
    write_snapshots(a.raw_positions(), tmp_path / "all", 3)
    (tmp_path / "in").mkdir()
    for step, part in enumerate((2, 0, 1)):
        (tmp_path / "in" / f"{part:03d}.json").write_text((tmp_path / "all" / f"{part:03d}.json").read_text())
        realtime.realtime_cycle(
            spark, str(tmp_path / "in"), str(tmp_path / "work"), "kept", ingested_at=F.lit(f"2026-09-20T10:{step:02d}:00"),
            wait_seconds=0, keep_activity=True,
        )
        same_views(spark, "kept", a.dim_route(), a.weather())


def pings(rows, *data):
    kinds = "entity_id string, vehicle_id string, route_id string, ping_hour int, derived_speed_kmh double, ingested_at string, timestamp string, ingest_day date, ping_date date"
    full = [(f"e{i}", v, "r", h, s, w, f"t{i}", dt.date(2026, 1, 1), d) for i, (v, h, s, w, d) in enumerate(data)]
    out = rows(full, kinds)
    missing = [c for c in loads.schemas.names(loads.schemas.FACT_POSITIONS) if c not in out.columns]
    types = {f.name: f.dataType for f in out.sparkSession.createDataFrame([], loads.schemas.FACT_POSITIONS).schema}
    return out.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in missing])


def test_a_load_lost_before_the_refresh_is_made_up_for(spark, rows, tmp_path):
    day = lambda n: dt.date(2026, 1, n)
    root = str(tmp_path)
    first = [("v", 1, 5.0, "2026-01-01T00:00:00", day(1)), ("v", 2, 1.0, "2026-01-01T00:00:00", day(2)), (None, 2, None, "2026-01-01T00:00:00", day(3))]
    second = [*first, ("w", 1, 7.0, "2026-01-01T01:00:00", day(1)), ("v", 3, 9.0, "2026-01-01T01:00:00", None)]
    third = [*second, ("w", 2, 3.0, "2026-01-01T02:00:00", day(2))]

    def load(data, finish=True):
        source = pings(rows, *data)
        new = loads.pending_positions(spark, source, "made")
        activity.touch(spark, "made", versioned.parts_of(new, activity.DAY))
        loads.load_positions(spark, source, "made", root)
        if finish:
            activity.refresh(spark, "made", root)

    kept = lambda: tables.read(spark, f"made.{activity.PARTIALS}")
    total = lambda: kept().agg(F.sum("pings")).first()[0]
    load(first)
    files = set(kept().inputFiles())
    load(second, finish=False)
    assert total() == 3
    load(third)
    assert total() == 6
    # The day that neither load touched was not made anew.
    assert len(files & set(kept().inputFiles())) == 1
    per_day = {r.ping_date: (r.n, r.v) for r in kept().groupBy("ping_date").agg(F.sum("pings").alias("n"), F.count("vehicle_id").alias("v")).collect()}
    assert per_day == {day(1): (2, 2), day(2): (2, 2), day(3): (1, 0), None: (1, 1)}
    load(third)  # nothing new
    assert total() == 6


def test_partials_add_up(rows):
    kept = activity.partials(pings(rows, ("v", 1, 5.0, "x", dt.date(2026, 1, 1)), ("v", 1, 1.0, "x", dt.date(2026, 1, 1))))
    assert [(r.pings, r.stopped, r.speeds, r.speed_sum) for r in kept.collect()] == [(2, 1, 1, 5.0)]
