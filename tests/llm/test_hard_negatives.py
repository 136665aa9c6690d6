import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from omnibus.llm import hard_negatives

VEC = "vec_id bigint, embedding array<float>, label int, v string, key string, slot string, place string, score string"


def moved_label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def brute(rows, positives, negatives, every):
    width = max([len(e) for _, e, _ in rows if e] or [1])
    seen = set()
    for i, e, label in rows:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        x = tuple(math.floor(256 * x) for x in np.array(e, dtype=np.float32).astype(float))
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, x + (0,) * (width - len(x))))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for q, label, a in seen:
        if q % every:
            continue
        ranked = sorted((-dot(a, b), i, other == label) for i, other, b in seen if i != q)
        for top, p, _ in [r for r in ranked if r[2]][:positives]:
            band = [r for r in ranked if not r[2] and 30 * -top <= 100 * -r[0] <= 90 * -top][:negatives]
            out += [(q, p, n + 1, i, -top, -s) for n, (s, i, _) in enumerate(band)]
    return sorted(out)


def run(spark, rows, positives=5, negatives=10, every=10):
    df = spark.createDataFrame([(i, e, label, None, None, None, None, None) for i, e, label in rows], VEC)
    got = hard_negatives.mine(df, lambda i: i % every == 0, moved_label(), positives, negatives)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, got.collect()))
    assert got == brute(rows, positives, negatives, every)
    return got


@pytest.mark.parametrize("block", [4096, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 3)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0.2, 0.4) for _ in range(6)], rng.choice([1, 1, 1, 2, 3, None])) for i in range(400)]
    assert len(run(spark, rows)) > 500


def test_ties_and_copies(spark):
    # One vector stands in a third of the rows, under all labels.
    rng = random.Random(6)
    common = [0.5, 0.25, -0.125]
    rows = [(i, common if i % 3 else [rng.random() for _ in range(3)], i % 4) for i in range(150)]
    assert run(spark, rows + rows[:50])


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (10, None, 1), (20, [1.0, float("nan")], 1), (30, [float("inf")], 1),
        (40, [None, 1.0], 1), (None, [1.0], 1), (50, [1.0, 1.0], None), (3, [], 1), (5, [1.0], 1), (6, [0.75], 2),
        (8, [0.5, 0.25], 2), (9, [-3.0, -3.0], 2), (60, [2.0], 5), (70, [], 1), (13, [1.0, 0.5], 2),
    ]
    got = run(spark, rows)
    assert {r[0] for r in got} >= {0}


def test_negative_and_zero_positives(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [-0.5, 0.0], 2), (4, [0.0, 2.0], 2)]
    # A positive of score 0 takes negatives of score 0, and one below 0 none.
    assert run(spark, rows) == [(0, 2, 1, 4, 0, 0)]


def test_rows_that_share_an_id(spark):
    # Anchor 0 stands twice with different vectors: each has its own positives, under one id.
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 0.25], 1), (2, [0.5, 0.25], 2), (3, [0.25, 0.125], 2)]
    assert {r[0] for r in run(spark, rows)} == {0}


@pytest.mark.parametrize("scale", [1.0, 2.0**12, 2.0**22, 2.0**40])
def test_fields_of_every_width(scale):
    rng = random.Random(8)
    v = np.array([[int(rng.uniform(-256, 256) * scale) for _ in range(5)] for _ in range(40)], dtype=np.int64)
    packed = hard_negatives.Packed(v, int(np.abs(v).max()))
    assert packed.bytes == {1.0: 4, 2.0**12: 8, 2.0**22: 16, 2.0**40: 16}[scale]
    for a in v.tolist():
        exact = [sum(x * y for x, y in zip(a, b)) for b in v.tolist()]
        assert packed.scores(a).tolist() == [min(max(s, -(2**63)), 2**63 - 1) for s in exact]


def test_empty_table(spark):
    assert run(spark, []) == []
