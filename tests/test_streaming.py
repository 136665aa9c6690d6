import datetime as dt
import json
import os

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from omnibus.plans import loads, silver
from omnibus.plans import observations as obs
from omnibus.plans.analogs import Analogs
from omnibus.streaming import observations as intake_stream
from omnibus.streaming import positions as realtime

SF = "/root/testdata/sf0.001"
SHOWN = ["entity_id", "vehicle_id", "timestamp", "derived_speed_kmh", "ping_date", "ping_hour"]


def write_snapshots(bronze, folder, parts):
    """The pings in time order, one snapshot file per slice of the period."""
    folder.mkdir(parents=True)
    found = sorted(bronze.collect(), key=lambda r: (r["timestamp"], r["entity_id"]))
    size = -(-len(found) // parts)
    vehicle = ["vehicle_id", "trip_id", "route_id", "latitude", "longitude", "speed", "timestamp", "status"]
    for i in range(parts):
        entity = [{"id": r["entity_id"], "vehicle": {c: r[c] for c in vehicle}} for r in found[i * size:(i + 1) * size]]
        path = folder / f"{i:03d}.json"
        path.write_text(json.dumps({"entity": entity}))
        stamp = 1_700_000_000 + i
        os.utime(path, (stamp, stamp))


@pytest.mark.parametrize("parts", [1, 5])
def test_micro_batches_equal_the_batch_build(spark, tmp_path, parts):
    raw = Analogs(spark, SF).raw_positions()
    write_snapshots(raw, tmp_path / "in", parts)
    builder = realtime.realtime_cycle(
        spark, str(tmp_path / "in"), str(tmp_path / "work"), f"cycle{parts}", files_per_batch=1, wait_seconds=0
    )
    want = as_set(silver.vehicle_positions(raw).select(*SHOWN))
    assert as_set(builder.silver(spark).select(*SHOWN)) == want
    assert builder.silver(spark).select("batch_id").distinct().count() == parts
    assert as_set(spark.table(f"cycle{parts}.{loads.POSITIONS}").select(*SHOWN)) == want


def test_cycle_resumes_and_a_replayed_batch_changes_nothing(spark, tmp_path):
    raw = Analogs(spark, SF).raw_positions()
    write_snapshots(raw, tmp_path / "all", 3)
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "work")
    for i in range(3):
        (tmp_path / "in" / f"{i:03d}.json").write_text((tmp_path / "all" / f"{i:03d}.json").read_text())
        stamp = F.lit(f"2026-09-20T10:{i:02d}:00")
        builder = realtime.realtime_cycle(spark, str(tmp_path / "in"), root, "resumed", ingested_at=stamp, wait_seconds=0)
    want = as_set(silver.vehicle_positions(raw).select(*SHOWN))
    assert as_set(builder.silver(spark).select(*SHOWN)) == want
    assert as_set(spark.table(f"resumed.{loads.POSITIONS}").select(*SHOWN)) == want
    bronze = spark.read.parquet(f"{root}/bronze_positions")
    builder(bronze.where("ingested_at = '2026-09-20T10:02:00'"), 2)
    assert as_set(builder.silver(spark).select(*SHOWN)) == want


def test_late_ping_gets_its_speed_and_corrects_the_next_one(spark, rows, tmp_path):
    from test_silver import ping

    from omnibus.schemas import BRONZE_POSITIONS

    builder = realtime.SilverBuilder(spark, "late", str(tmp_path))
    first = [ping("e1", "v", "2026-09-01T10:00:00+05:30"), ping("e3", "v", "2026-09-05T10:00:00+05:30", lat=28.7)]
    late = [ping("e2", "v", "2026-09-01T11:00:00+05:30", lat=28.61), ping("e1x", "v", "2026-09-01T10:00:00+05:30")]
    builder(rows(first, BRONZE_POSITIONS), 0)
    for _ in range(2):  # a replay changes nothing
        builder(rows(late, BRONZE_POSITIONS), 1)
        out = {r["entity_id"]: r["derived_speed_kmh"] for r in builder.silver(spark).collect()}
        assert set(out) == {"e1", "e2", "e3"}  # the copy of e1 is dropped
        assert out["e2"] == pytest.approx(1.11195, rel=1e-3)
        assert as_set(builder.silver(spark).select(*SHOWN)) == as_set(
            silver.vehicle_positions(rows(first + late, BRONZE_POSITIONS)).select(*SHOWN)
        )
    assert builder.latest(spark).first()["entity_id"] == "e3"


def test_any_order_of_batches_gives_the_batch_build(spark, rows, tmp_path):
    """Zones, days without pings, unreadable times, missing vehicles and copies, in shuffled batches."""
    import random

    from test_silver import ping

    from omnibus.schemas import BRONZE_POSITIONS

    draw = random.Random(5)
    pings = []
    for i in range(160):
        at = dt.datetime(2026, 9, 1) + dt.timedelta(minutes=draw.randrange(6 * 24 * 6) * 10)
        text = at.strftime("%Y-%m-%dT%H:%M:%S") + draw.choice(["+05:30", "-11:00", "Z"])
        text = draw.choice([text] * 12 + ["soon", None])
        vehicle = draw.choice(["a", "a", "b", "c", None])
        pings.append(ping(f"e{i:03d}", vehicle, text, lat=28.5 + draw.random() / 10, ingested=f"2026-09-20T00:00:{i // 40:02d}"))
    # Arrival follows ingestion, so the copy that arrives first is the one to keep.
    builder = realtime.SilverBuilder(spark, "anyorder", str(tmp_path))
    for n in range(4):
        builder(rows(pings[n * 40:(n + 1) * 40], BRONZE_POSITIONS), n)
    want = silver.vehicle_positions(rows(pings, BRONZE_POSITIONS)).select(*SHOWN)
    assert sorted(map(str, builder.silver(spark).select(*SHOWN).collect())) == sorted(map(str, want.collect()))


def test_late_pings_reach_the_warehouse(spark, tmp_path):
    raw = Analogs(spark, SF).raw_positions()
    write_snapshots(raw, tmp_path / "all", 3)
    (tmp_path / "in").mkdir()
    for step, part in enumerate((2, 0, 1)):
        (tmp_path / "in" / f"{part:03d}.json").write_text((tmp_path / "all" / f"{part:03d}.json").read_text())
        stamp = F.lit(f"2026-09-20T10:{step:02d}:00")
        realtime.realtime_cycle(
            spark, str(tmp_path / "in"), str(tmp_path / "work"), "lateload", ingested_at=stamp, wait_seconds=0
        )
    want = as_set(silver.vehicle_positions(raw).select(*SHOWN[1:]))
    assert as_set(spark.table(f"lateload.{loads.POSITIONS}").select(*SHOWN[1:])) == want


def test_late_ping_reads_only_days_it_needs(spark, rows, tmp_path):
    from test_silver import ping

    from omnibus.schemas import BRONZE_POSITIONS

    builder = realtime.SilverBuilder(spark, "bounded", str(tmp_path))
    days = [ping(f"e{d}", "v", f"2026-08-{d:02d}T10:00:00+05:30") for d in range(1, 29)]
    builder(rows(days, BRONZE_POSITIONS), 0)
    files = {f for f in builder.silver(spark).inputFiles()}
    builder(rows([ping("x", "v", "2026-08-14T09:00:00+05:30", lat=28.61)], BRONZE_POSITIONS), 1)
    kept = files & set(builder.silver(spark).inputFiles())
    assert len(files) == 28 and len(kept) == 27  # only the day of the corrected ping is rewritten
    near = builder.silver(spark).where(realtime.tables.on_days("ping_date", {20_679}))
    assert near.inputFiles() and len(near.inputFiles()) < len(builder.silver(spark).inputFiles())


def test_a_bad_ping_stops_the_load(spark, rows, tmp_path):
    from omnibus.operators.quality import QualityGateFailed
    from omnibus.sources import versioned

    raw = Analogs(spark, SF).raw_positions()
    write_snapshots(raw, tmp_path / "in", 1)
    root = str(tmp_path / "work")
    builder = realtime.realtime_cycle(
        spark, str(tmp_path / "in"), root, "gated", ingested_at=F.lit("2026-09-20T10:00:00"), wait_seconds=0
    )
    before = spark.table(f"gated.{loads.POSITIONS}").count()
    bad = builder.silver(spark).limit(1).withColumns({
        "entity_id": F.lit("bad"), "timestamp": F.lit("2026-09-21T00:00:00Z"), "derived_speed_kmh": F.lit(500.0),
        "ingested_at": F.lit("2026-09-21T10:00:00"), "ingest_day": F.lit("2026-09-21").cast("date"),
    })
    versioned.append(bad, builder.positions)
    with pytest.raises(QualityGateFailed, match="speed bound: 1"):
        realtime.realtime_cycle(spark, str(tmp_path / "in"), root, "gated", wait_seconds=0)
    assert spark.table(f"gated.{loads.POSITIONS}").count() == before


def test_load_waits_for_the_landing(spark, tmp_path):
    calls = []

    class Boom(Exception):
        pass

    def fail(*a, **k):
        calls.append(1)
        raise Boom

    original = realtime.land
    realtime.land = fail
    try:
        with pytest.raises(Boom):
            realtime.realtime_cycle(spark, "x", str(tmp_path), "never", retries=1, wait_seconds=0)
    finally:
        realtime.land = original
    assert len(calls) == 2 and not spark.catalog.tableExists(f"never.{loads.POSITIONS}")


def test_intake_stream_equals_one_batch(spark, tmp_path):
    a = Analogs(spark, SF)
    codes, submitted = a.qr_codes(), a.submissions()
    want = as_set(obs.classify(submitted, codes), "id", "verdict")
    incoming = tmp_path / "in"
    edges = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8, 10, 30), dt.datetime(2024, 1, 19, 3, 3), dt.datetime(2024, 3, 1)]
    intake = intake_stream.Intake(spark, codes, "intake.classified", str(tmp_path / "out"))
    for lo, hi in zip(edges, edges[1:]):
        part = submitted.where((F.col("created_at") >= F.lit(lo)) & (F.col("created_at") < F.lit(hi)))
        part.coalesce(1).write.mode("append").parquet(str(incoming))
        intake_stream.run_intake(spark, str(incoming), intake, str(tmp_path / "progress"))
    assert as_set(intake.classified(spark), "id", "verdict") == want
    assert intake.classified(spark).select("batch_id").distinct().count() == 3
