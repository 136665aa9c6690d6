import datetime as dt
import random

import pytest

from omnibus.operators.ranking import rank_by_value


def ranks(values):
    known = [v for v in values if v is not None]
    return sorted(((v, 1 + sum(w > v for w in known)) if v is not None else (None, len(known) + 1) for v in values), key=repr)


@pytest.mark.parametrize("stretches", [2, 7, 256])
@pytest.mark.parametrize("kind", ["bigint", "double", "date"])
@pytest.mark.parametrize("few", [0, 1000])
def test_equals_sql_rank(rows, stretches, kind, few):
    rng = random.Random(stretches)
    make = {"bigint": lambda: rng.randint(-50, 50), "double": lambda: rng.choice([1.5, -2.0, rng.random()]),
            "date": lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(40))}[kind]
    values = [rng.choice([None, make(), make(), make()]) for _ in range(300)]
    got = rank_by_value(rows([(v,) for v in values], f"v {kind}"), "v", stretches=stretches, few=few)
    assert got.columns == ["v", "rank"]
    assert sorted(((r.v, r.rank) for r in got.collect()), key=repr) == ranks(values)


@pytest.mark.parametrize("values", [[], [None, None], [3], [5, 5, 5]])
@pytest.mark.parametrize("few", [-1, 10])
def test_few_values(rows, values, few):
    got = rank_by_value(rows([(v,) for v in values], "v bigint"), "v", few=few)
    assert sorted(((r.v, r.rank) for r in got.collect()), key=repr) == ranks(values)


def test_no_task_holds_all_values(spark):
    """Values are counted in many stretches; only the stretches' totals meet in one task."""
    df = spark.range(0, 50_000, 1, 8).selectExpr("(id * 7919) % 40000 AS v")
    got = rank_by_value(df, "v", few=10_000)
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    singles = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # Below each of them stands an aggregate: the quantiles' sketch or the totals by stretch.
    assert all("HashAggregate" in lines[i + 1] or "ObjectHashAggregate" in lines[i + 1] for i in singles)
    assert "partial_sum" in "".join(lines) and got.where("rank = 1").count() == df.where("v = 39999").count()
