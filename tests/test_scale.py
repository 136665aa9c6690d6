"""Plan properties that matter beyond one machine."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from omnibus.operators.access import Viewer, visible
from omnibus.operators.dedupe import keep_first
from omnibus.plans import silver
from omnibus.plans.analogs import Analogs
from omnibus.plans.catalog import model
from omnibus.plans.report import report_query
from omnibus.session import prepare
from omnibus.sources.shared import shared_folder


@pytest.fixture
def settings(spark):
    """Set and restore session settings."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = "spark.sql." + name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_route_is_split_under_row_level_security(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1", shuffle__partitions="32",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
    )
    prepare(spark)
    n = 300_000
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 1000))
    pings = spark.range(0, n, 1, 8).select(
        hot.alias("route_id"), F.col("id").cast("string").alias("vehicle_id"),
        F.concat(F.lit("at"), F.col("id")).alias("timestamp"), F.lit(1.0).alias("speed"), F.lit(1).alias("status"),
    )
    routes = pings.select("route_id").distinct()
    model = {
        "fact_vehicle_positions": pings,
        "dim_route": routes,
        "user_route_access": routes.select(F.lit("dm").alias("user_email"), "route_id"),
    }
    df = report_query(model, "v33", viewer=Viewer("Depot Manager", "dm"))
    plan = final_plan(df.groupBy().agg(F.count("*").alias("n")))
    assert "SortMergeJoin(skew=true)" in plan
    assert df.count() == n


def test_copies_of_one_ping_collapse_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = final_plan(keep_first(df, ["k"], ["o"]))
    below = plan[plan.index("Exchange hashpartitioning(k"):]
    assert "partial_min" in below


def test_pings_and_their_summary_share_the_deduplication(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    raw = Analogs(spark, "/root/testdata/sf0.001").raw_positions()
    assert "ReusedExchange" in final_plan(silver.vehicle_positions(raw))


def test_interim_files_lie_in_the_named_folder_or_beside_the_tables(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    set_to = []
    unnamed = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, *a: "hdfs://x/warehouse/" if key == "spark.sql.warehouse.dir" else None),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=set_to.append),
    )
    assert shared_folder(unnamed) == "hdfs://x/warehouse/_interim" == set_to[0]


@pytest.mark.parametrize("table", ["route_schedule_summary", "vehicle_activity"])
def test_role_filter_lies_below_the_first_aggregate(spark, table):
    a = Analogs(spark, "/root/testdata/sf0.01")
    viewer = Viewer("Depot Manager", "user7")
    narrowed = visible(model(a), table, viewer=viewer)
    plan = narrowed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda word: [len(line) - len(line.lstrip(" :+-")) for line in plan if word in line]
    assert min(depth("LeftSemi")) > min(depth("Aggregate"))
    # The rows are those of a filter on top.
    own = visible(model(a), "dim_route", viewer=viewer).select("route_id")
    whole = model(a)[table].join(own, "route_id", "left_semi")
    assert as_dict_rows(narrowed) == as_dict_rows(whole) != []


def as_dict_rows(df):
    return sorted(str(r.asDict()) for r in df.collect())
