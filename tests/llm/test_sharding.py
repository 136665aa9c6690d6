import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from omnibus.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11, 100, 101, 1023, 4099])
def test_permutation(spark, n):
    a, b = sharding.radices(n)
    assert a * b >= n
    got = [r[0] for r in spark.range(n).select(sharding.permuted(spark, F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n))


def test_seed_changes_the_order(spark):
    one, two = (
        [r[0] for r in spark.range(500).select(sharding.permuted(spark, F.col("id"), 500, seed)).collect()] for seed in (1, 2)
    )
    assert one != two and one != sorted(one)


def check(df, shards=8):
    rows = sharding.shards(df, shards).collect()
    given = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == given
    counts = Counter(r.shard for r in rows)
    assert not rows or max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)
    return sorted(map(tuple, rows), key=repr)


def test_edge_rows(edge_docs):
    check(edge_docs)


def test_same_result_for_any_partitioning(docs):
    pairs = [(i, f"text {i % 50} é") for i in range(1000)]
    assert check(docs(pairs).repartition(7)) == check(docs(pairs[::-1]).coalesce(2))


def test_a_third_of_the_rows_alike(docs, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 16)
    check(docs([(7, "same")] * 300 + [(i, str(i)) for i in range(600)]))


def test_empty_and_single(docs):
    assert check(docs([])) == []
    check(docs([(1, "x")]))


def test_only_built_in_operators(docs):
    plan = sharding.shards(docs([(i, str(i)) for i in range(50)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
