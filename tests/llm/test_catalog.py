"""Queries against their SQL, and the pipeline against its operators."""

import duckdb
import pytest

import corpus_pipeline
from omnibus.llm import bpe, decontamination, ngram_join, stages, toxicity
from omnibus.llm.catalog import QUERIES, SQL
from omnibus.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(repr(v + 0.0) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(SQL[name])
    columns = sorted(d[0] for d in result.description)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    assert plain(df.select(*columns).collect()) == plain(result.df()[columns].astype(object).where(lambda x: x.notna(), None).values)


def test_all_queries():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stages.reread(stage(spark, kept, SF), name)
        assert after.columns == docs.columns
        assert after.exceptAll(kept).isEmpty() and not after.isEmpty()
        kept = after
    ids = {r.doc_id for r in kept.collect()}
    # Nothing left is toxic, a copy or contaminated, and the last stage encodes each document.
    assert {r.n_links for r in ngram_join.join(kept).collect()} == {0}
    assert decontamination.contained(kept, table(spark, SF, "benchmark")).count() == 0
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert not ids & bad
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    vocabulary = bpe.WordBpe.from_file(bpe.vocabulary_path())
    assert got == {r.doc_id: len(vocabulary.encode(r.text)) // 4 for r in kept.collect()}
