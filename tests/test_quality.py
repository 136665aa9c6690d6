import pytest
from helpers import as_dict
from pyspark.sql import functions as F

from omnibus.operators import quality
from omnibus.plans import checks
from omnibus.plans.analogs import Analogs
from omnibus.sources import tables, versioned

SF = "/root/testdata/sf0.001"


def found(df):
    return {k: v["violations"] for k, v in as_dict(df, "check").items()}


def test_speed_bound(rows):
    df = rows([(120.0,), (120.01,), (None,)], "derived_speed_kmh double")
    assert found(checks.speed_bound(df)) == {"speed bound": 1}


def test_position_rules(rows):
    df = rows([("v", "a", 28.5, 77.0), ("v", "a", 28.5, 77.0), ("v", "b", 0.0, 0.0), ("w", "a", None, 77.0)],
              "vehicle_id string, timestamp string, latitude double, longitude double")
    assert found(checks.position_rules(df)) == {"ping outside box": 2, "unique ping": 1}


def test_orphans_count_rows_and_ignore_null(rows):
    facts = rows([("a",), ("x",), ("x",), (None,)], "k string")
    assert found(quality.orphans("o", facts, "k", rows([("a",)], "id string"), "id")) == {"o": 2}


def test_gate_passes_orphans_but_not_violations(rows):
    ok = rows([("speed bound", 0), ("orphan a.b", 9)], "check string, violations long")
    quality.gate(ok)
    with pytest.raises(quality.QualityGateFailed, match="unique x: 2"):
        quality.gate(ok.unionByName(rows([("unique x", 2)], "check string, violations long")))


def test_gate_on_a_star(spark):
    a = Analogs(spark, SF)
    with pytest.raises(quality.QualityGateFailed, match="speed bound"):
        quality.gate(checks.all_checks(a.star(), a.observations()))


def test_a_write_counts_its_rows_and_stops_before_they_show(spark, rows, tmp_path):
    rules = {"negative": F.col("x") < 0, "missing": F.col("x").isNull()}
    part = lambda *xs: rows([(x, 1) for x in xs], "x int, d int")
    root = str(tmp_path)
    for writer in (tables, versioned):
        name = f"watched.{writer.__name__.split('.')[-1]}"
        with pytest.raises(quality.QualityGateFailed, match="negative: 2, missing: 1") as failed:
            writer.publish(part(1, -2, -3, None), name, root, ("d",), rules)
        assert failed.value.violations == {"negative": 2, "missing": 1} and not tables.exists(spark, name)
        writer.publish(part(1, 2), name, root, ("d",), rules)
        with pytest.raises(quality.QualityGateFailed, match="missing: 1"):
            writer.publish(part(3, None), name, root, ("d",), rules)
        assert {r.x for r in spark.table(name).collect()} == {1, 2}
    with pytest.raises(quality.QualityGateFailed, match="negative: 1"):
        versioned.append(part(7, -7), name, rules)
    assert {r.x for r in tables.read(spark, name).collect()} == {1, 2}
    versioned.append(part(7), name, rules)
    assert {r.x for r in tables.read(spark, name).collect()} == {1, 2, 7}


def test_counting_adds_no_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "in"))
    watch = quality.Watch(spark.read.parquet(str(tmp_path / "in")), {"odd": F.col("id") % 2 == 1})
    plan = watch.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "CollectMetrics" in plan
    watch.rows.write.parquet(str(tmp_path / "out"))
    assert watch.counts() == {"odd": 50}
