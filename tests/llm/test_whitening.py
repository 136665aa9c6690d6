import math
import random

import numpy as np
import pytest

from omnibus.llm import whitening
from omnibus.llm.catalog import QUERIES

VEC = "vec_id bigint, embedding array<float>, label int, v string, component int, n string, total string"
SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, None, None, None, None) for i, e in rows], VEC)


def integers(rows):
    """(ids, x) of the rows that take part, in Python integers."""
    kept = [(i, e) for i, e in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    width = max([len(e) for _, e in kept] or [1])
    floats = [[float(np.float32(c)) for c in e] + [0.0] * (width - len(e)) for _, e in kept]
    return [i for i, _ in kept], [[math.floor(64 * c) + 1000000 for c in e] for e in floats]


def whitened(spark, rows, components=32):
    df = frame(spark, rows)
    return whitening.whiten(df, whitening.fit(df, components)).collect()


def check(got, ids, x, components=32):
    n, width = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    d = np.array(x, dtype=np.longdouble) - np.array(s, dtype=np.longdouble) / n
    v = (d.T @ d / n).astype(float)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == n * count
    places = {}
    for r in got:
        places.setdefault(r.vec_id, []).append(r)
    want = (d.astype(float) @ vectors[:, :count]) / np.sqrt(values[:count])
    signs = None
    for i, row, w in zip(ids, x, want):
        mine = sorted((r for r in places[i]), key=lambda r: r.component)
        assert {r.component for r in mine} == set(range(1, count + 1))
        for r in mine:
            assert r.n == n and r.deviation == r.deviation_exact == sum((n * a - b) ** 2 for a, b in zip(row, s))
            assert r.explained == pytest.approx(values[r.component - 1] / v.trace(), rel=1e-9)
            assert r.identity_error < 1e-9
        y = np.array([r.whitened for r in mine[:: len(mine) // count]])
        if signs is None and (np.abs(w) > 1e-3).all():
            signs = np.sign(y * w)
        if signs is not None:
            assert y * signs == pytest.approx(w, abs=1e-7)


def test_equals_plain_algebra(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(k, 3 / (k + 1)) for k in range(10)]) for i in range(200)]
    check(whitened(spark, rows), *integers(rows))
    check(whitened(spark, rows, 4), *integers(rows), components=4)


def test_query_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, SF).collect(), *integers(rows))


def test_whitened_covariance_is_the_identity(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)]
    got = whitened(spark, rows)
    y = np.zeros((80, 6))
    for r in got:
        y[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(y.mean(axis=0)).max() < 1e-12
    error = np.abs(y.T @ y / 80 - np.eye(6)).max()
    assert error < 1e-12 and got[0].identity_error == pytest.approx(error, abs=1e-13)


def test_lower_rank_and_constant_dimensions(spark):
    rng = random.Random(6)
    # Dimension 2 repeats dimension 0 and dimension 3 is constant: two components.
    rows = [(i, [float(a), float(b), float(a), 7.0]) for i, (a, b) in enumerate((rng.randint(0, 9), rng.randint(0, 5)) for _ in range(50))]
    got = whitened(spark, rows)
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9


def test_edge_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]),
        (None, [0.5, -3.0]), (6, []), (7, [4.0]),
    ]
    got = whitened(spark, rows)
    check([r for r in got], *integers(rows))
    assert {r.vec_id for r in got} == {1, None, 6, 7}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, []), (2, [])]])
def test_too_few_vectors(spark, rows):
    assert whitened(spark, rows) == []


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**40 * (i % 3) + 2**30 * i), float(-(i**3))]) for i in range(40)]
    ids, x = integers(rows)
    s = [sum(col) for col in zip(*x)]
    exact = {i: sum((40 * a - b) ** 2 for a, b in zip(row, s)) for i, row in zip(ids, x)}
    for r in whitened(spark, rows):
        assert r.deviation_exact == exact[r.vec_id]
        assert r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None)


def test_huge_entries(spark):
    # Entries stop at the limit; nothing overflows.
    assert {r.component for r in whitened(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])} <= {1, 2}


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [3.0, 1.0], np.linspace(9, 1, 40), [4.0] * 6 + [1.0] * 6, [1e6, 1.0, 1e-4, 1e-4], [2.0, 2.0 + 1e-13, 1.0, 1.0 - 1e-12, 0.5],
        1.0 / np.arange(1, 65) ** 4,
    ],
)
def test_solvers(values):
    values = np.sort(np.array(values))[::-1]
    matrix = symmetric(values)
    found, vectors = whitening.principal(matrix, len(values))
    norm = values[0]
    assert found == pytest.approx(values[: len(found)], abs=norm * 1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < norm * 1e-13


def test_diagonal_matrices():
    for values in ([3.0, 3.0, 3.0], [1.0, 5.0, 2.0], [0.0, 0.0, 7.0]):
        found, vectors = whitening.principal(np.diag(values), 3)
        assert found == pytest.approx([v for v in sorted(values, reverse=True) if v])
        assert np.abs(np.diag(values) @ vectors - vectors * found).max() < 1e-12


def test_sturm_counts():
    rng = np.random.default_rng(3)
    d, e = rng.normal(size=20), rng.normal(size=19)
    exact = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 60)
    assert whitening.count_below(d, e, at).tolist() == [(exact < a).sum() for a in at]
