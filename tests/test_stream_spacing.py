import datetime as dt
import random

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from omnibus import params
from omnibus.plans import observations as obs
from omnibus.streaming import spacing
from omnibus.streaming.observations import SUBMISSION

START = dt.datetime(2026, 1, 1)
CODES = "id bigint, qr_token string, bus_number string, route_id string, is_active boolean"


def submission(i, token, at, who="p", severity="HIGH"):
    return (i, token, params.PROBLEM_TYPES[0], severity, None, at, None, None, who, at)


@pytest.fixture
def codes(rows):
    return rows([(1, "a", "b1", "r1", True), (2, "b", "b2", "r2", True), (3, "off", "b3", "r3", False)], CODES)


def feed(spark, rows, codes, folder, batches, lateness="6 hours"):
    """Each batch lands as files of its own and is judged; a heartbeat ends the feed."""
    for batch in batches:
        rows(batch, SUBMISSION).repartition(2).write.mode("append").parquet(f"{folder}/in")
        spacing.run_spaced_intake(spark, f"{folder}/in", codes, f"{folder}/out", f"{folder}/progress", lateness)
    last = max(r[-1] for b in batches for r in b if r[-1] is not None)
    end = spacing.heartbeat(spark, F.lit(last + dt.timedelta(days=3)))
    end.write.mode("append").parquet(f"{folder}/in")
    spacing.run_spaced_intake(spark, f"{folder}/in", codes, f"{folder}/out", f"{folder}/progress", lateness)
    return spark.read.parquet(f"{folder}/out")


def test_shuffled_arrival_gets_the_verdicts_of_one_batch(spark, rows, codes, tmp_path):
    rng = random.Random(3)
    data = []
    for i in range(400):
        at = START + dt.timedelta(seconds=rng.randrange(3 * 86_400 // 60) * 60, microseconds=rng.choice([0, 0, 1, 999]))
        token = rng.choice(["a", "a", "a", "b", "off", "none"])
        data.append(submission(i, token, at, rng.choice(["p", "q"]), rng.choice(["HIGH"] * 9 + ["WORST"])))
    data.append(submission(400, "a", None))
    want = as_set(obs.classify(rows(data, SUBMISSION), codes), "id", "verdict")
    # Up to just under six hours late.
    arrival = sorted(data, key=lambda r: (r[-1] or START) + dt.timedelta(seconds=rng.random() * 6 * 3600 * 0.99))
    batches = [arrival[:150], arrival[150:170], arrival[170:330], arrival[330:]]
    out = feed(spark, rows, codes, str(tmp_path), batches)
    assert as_set(out, "id", "verdict") == want and out.count() == len(data)


def test_ties_edges_and_a_late_row_inside_the_window(spark, rows, codes, tmp_path):
    at = lambda m, us=0: START + dt.timedelta(minutes=m, microseconds=us)
    first = [submission(5, "a", at(0)), submission(2, "a", at(0)), submission(3, "a", at(60)), submission(4, "a", at(60, 1))]
    late = [submission(6, "a", at(-30)), submission(7, "b", at(10)), submission(8, "a", at(31))]
    out = feed(spark, rows, codes, str(tmp_path), [first, late])
    # The late row at -30 comes first in time; so 0 falls into its window, and 31 is free again.
    verdicts = dict(as_set(out, "id", "verdict"))
    assert verdicts == {6: "accepted", 2: "duplicate", 5: "duplicate", 8: "accepted", 3: "duplicate", 4: "duplicate", 7: "accepted"}
    assert verdicts == dict(as_set(obs.classify(rows(first + late, SUBMISSION), codes), "id", "verdict"))


def test_rows_wait_for_the_watermark(spark, rows, codes, tmp_path):
    folder = str(tmp_path)
    rows([submission(1, "a", START), submission(2, "x", START)], SUBMISSION).write.parquet(f"{folder}/in")
    spacing.run_spaced_intake(spark, f"{folder}/in", codes, f"{folder}/out", f"{folder}/progress", "6 hours")
    assert as_set(spark.read.parquet(f"{folder}/out"), "id", "verdict") == {(2, "unknown_token")}
    rows([submission(3, "b", START + dt.timedelta(hours=7))], SUBMISSION).write.mode("append").parquet(f"{folder}/in")
    spacing.run_spaced_intake(spark, f"{folder}/in", codes, f"{folder}/out", f"{folder}/progress", "6 hours")
    assert as_set(spark.read.parquet(f"{folder}/out"), "id", "verdict") == {(2, "unknown_token"), (1, "accepted")}
