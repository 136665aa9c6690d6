import math
import random

import numpy as np
import pytest

from omnibus.llm import topk

VEC = "vec_id bigint, embedding array<float>, label int, v string, score string, slot string"


def brute(rows, k, width):
    seen = set()
    for i, e, *_ in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        seen.add((i, tuple(math.floor(64 * x) for x in e) + (0,) * (width - len(e))))
    out = []
    for q, a in seen:
        if q % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in seen if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=20, width=8):
    df = spark.createDataFrame([(i, e, 0, None, None, None) for i, e in rows], VEC)
    got = sorted(map(tuple, topk.search(df, lambda i: i % 20 == 0, k).collect()))
    assert got == brute(rows, k, width)
    return got


@pytest.mark.parametrize("block", [2048, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-2.0, -0.5, 0.0, 0.25, 1.0]) + rng.choice([0, rng.random()]) for _ in range(8)]) for i in range(300)]
    assert len(run(spark, rows)) == 15 * 20


def test_blocks_below_the_cutoff_leave_no_row():
    rng = np.random.default_rng(4)
    q, near, far = rng.integers(-50, 50, (6, 8)), rng.integers(-50, 50, (40, 8)), rng.integers(-2, 3, (40, 8))
    cutoff = np.sort(q @ near.T, axis=1)[:, -3]
    for c in (near, far, np.vstack([near, far])):
        row = {"q_ids": np.arange(6).tobytes(), "q_data": q.tobytes(), "c_ids": np.arange(100, 100 + len(c)).tobytes(),
               "c_data": c.tobytes(), "extra": cutoff.tobytes()}
        for kind in ("float64", "int64", "object"):
            got = sorted(zip(*(x.tolist() for x in topk._resolve_block(row, 3, 8, kind))))
            score = q @ c.T
            want = []
            for i in range(6):
                best = sorted((-s, j) for j, s in enumerate(score[i].tolist()) if s >= cutoff[i])[:3]
                want += [(i, 100 + j, -s) for s, j in best]
            assert got == sorted(want)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_many_slots(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 8)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = random.Random(11)
    # Most vectors are short, so that most blocks cannot reach the cutoff.
    rows = [(i, [rng.gauss(0, 3 if i % 40 < 3 else spread) for _ in range(8)]) for i in range(400)]
    run(spark, rows, k=4)


def test_negative_scores_and_ties(spark):
    rows = [(0, [1.0] * 8)] + [(i, [-1.0 - i % 3] * 8) for i in range(1, 80)]
    run(spark, rows, k=7)


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, [1.0, float("nan")]), (60, [float("inf")]), (80, [1.0, None]),
        (None, [9.0]), (3, []), (5, [1.0] * 8), (5, [1.0] * 8), (7, [0.0] * 8), (100, []),
    ]
    got = run(spark, rows)
    assert [r[2] for r in got if r[0] == 0] == [5, 3, 7, 100]


def test_large_components_stay_exact(spark):
    run(spark, [(i, [float(2**19 - i), -float(2**20 + 7 * i)] * 4) for i in range(45)])


def test_empty_table(spark):
    assert run(spark, []) == []
