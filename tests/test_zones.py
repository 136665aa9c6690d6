"""Results don't move with the zone of the process."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
NAMES = ("l2_incremental_positions", "t13_newer_rows", "s6_observation_export", "o7_by_type", "o14_display", "o4_listing")
SCRIPT = """
import hashlib, json, sys
from pyspark.sql import SparkSession
import __spark_entry__ as driver
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", sys.argv[1] + "/c").config("spark.sql.warehouse.dir", sys.argv[1] + "/w").getOrCreate())
queries, out = driver.queries(), {}
for name in sys.argv[2].split(","):
    df = queries[name](spark, "/root/testdata/sf0.001")
    rows = sorted(str(r) for r in df.select(*[df[c].cast("string") for c in df.columns]).collect())
    out[name] = [len(rows), hashlib.sha256("|".join(rows).encode()).hexdigest()]
print("RESULT" + json.dumps(out))
"""


def results(zone, folder, names):
    env = os.environ | {"TZ": zone, "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(folder), ",".join(names)], env=env, cwd=folder, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return json.loads(done.stdout.rpartition("RESULT")[2])


def test_process_zone_changes_nothing(tmp_path):
    import __spark_entry__ as driver

    names = [n for n in NAMES if n in driver.queries()]
    assert {"l2_incremental_positions", "t13_newer_rows", "s6_observation_export", "o7_by_type"} <= set(names)
    found = {}
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        folder = tmp_path / zone.replace("/", "_")
        folder.mkdir()
        found[zone] = results(zone, folder, names)
    assert found["UTC"] == found["Asia/Kolkata"] == found["America/New_York"]
    assert all(count for count, _ in found["UTC"].values())
