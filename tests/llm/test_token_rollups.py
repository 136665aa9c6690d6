import random
from collections import Counter as Count

import pytest

from omnibus.llm import token_rollups as rollups

CHANGE = "op string, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, n_bytes bigint"


@pytest.fixture
def rollup(spark, tmp_path):
    return rollups.Rollup(spark, str(tmp_path / "rollup"))


def totals(rollup):
    return sorted(map(tuple, rollup.totals().collect()), key=repr)


def brute(held):
    out = {}
    for rows in held.values():
        for s, g, t, tokens, size in rows:
            n = out.setdefault((s, g, t), [0, 0, 0])
            n[0], n[1], n[2] = n[0] + 1, n[1] + tokens, n[2] + size
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


def test_random_batches(spark, rollup):
    rng = random.Random(9)
    held = {}
    for number in range(4):
        changes = []
        for i in {rng.choice([None, *range(25)]) for _ in range(14)}:
            op = rng.choice(["insert", "delete", "revise", "revise"])
            t = rng.choice(["v1", "v2"])
            if op != "insert":
                held[i] = [r for r in held.get(i, []) if r[2] != t]
            new = (rng.choice(["a", None]), rng.choice(["en", "de"]), t, rng.randint(0, 9), rng.randint(0, 50))
            changes.append((op, i, *new))
            if op != "delete":
                held.setdefault(i, []).append(new)
        batch = spark.createDataFrame(changes, CHANGE)
        assert rollup.commit(f"b{number}", batch) and not rollup.commit(f"b{number}", batch)
        assert totals(rollup) == brute(held)


def test_a_batch_that_broke_off_is_not_seen_and_can_come_again(spark, rollup, monkeypatch):
    batch = spark.createDataFrame([("insert", 1, "a", "en", "v", 5, 9)], CHANGE)
    rollup.commit("one", batch)
    monkeypatch.setattr(spark, "range", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    more = spark.createDataFrame([("revise", 1, "a", "en", "v", 7, 9)], CHANGE)
    with pytest.raises(OSError):
        rollup.commit("two", more)
    monkeypatch.undo()
    assert totals(rollup) == [("a", "en", "v", 1, 5, 9)]
    assert rollup.commit("two", more) and totals(rollup) == [("a", "en", "v", 1, 7, 9)]


def test_deleting_all_leaves_no_group(spark, rollup):
    rollup.commit("one", spark.createDataFrame([("insert", 1, "a", "en", "v", 5, 9)] * 3, CHANGE))
    rollup.commit("two", spark.createDataFrame([("delete", 1, None, None, "v", 0, 0), ("delete", 8, None, None, "v", 0, 0)], CHANGE))
    rollup.commit("none", spark.createDataFrame([], CHANGE))
    assert totals(rollup) == []


def test_load_equals_counting_each_text(edge_docs, rollup):
    counter = rollups.Counter.installed()
    expected = Count()
    for r in edge_docs.collect():
        expected.update({"docs": 1, "tokens": counter.count(r.text or ""), "bytes": len((r.text or "").encode())})
    assert totals_of(rollups.load(edge_docs, rollup, counter)) == [("s", "en", "byte_bpe_50k", *expected.values())]


def totals_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_empty_table(docs, rollup):
    assert totals_of(rollups.load(docs([]), rollup, rollups.Counter.installed())) == []


def test_deltas_of_many_sources_are_written_by_many_tasks(spark, rollup):
    rows = [("insert", i, f"s{i}", "en", "v", 1, 1) for i in range(400)]
    kinds = "op string, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, n_bytes bigint"
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        rollup.commit("many", spark.createDataFrame(rows, kinds))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(spark.read.parquet(f"{rollup.folder}/deltas/batch=many").inputFiles()) == 4
    assert rollup.totals().count() == 400
