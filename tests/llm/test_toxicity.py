import random
import zlib

import pytest
from pyspark.sql import functions as F

from omnibus.llm import toxicity

LABEL = "doc_id bigint, quality int, toxic int"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture(scope="module")
def corpus():
    """Texts with insults, some written with signs in them, and a made-up insult only labels teach."""
    rng = random.Random(8)
    words = [f"term{i}" for i in range(300)] + ["you", "we", "is"]
    rows = []
    for i in range(900):
        w = rng.choices(words, k=rng.randint(20, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moron", "grobnik", "scum"]))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus], "doc_id bigint, text string")
    return toxicity.fit(docs, spark.createDataFrame([(i, 1, y) for i, _, y in corpus], LABEL))


def test_held_out_accuracy(spark, corpus, model):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = {i: y for i, _, y in corpus}
    held = [i for i in rows if fold(i) == 0]
    assert len(rows) == 900 and all(rows[i].held_out == (fold(i) == 0) for i in rows)
    assert sum(rows[i].predicted == truth[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert "grobnik" in model.strong + model.weak


def test_edge_rows_keep_their_columns(edge_docs, model):
    rows = toxicity.score(edge_docs, model)
    assert rows.select("row.*").columns == edge_docs.columns
    got = rows.collect()
    assert len(got) == edge_docs.count() and all(r.score is not None and r.held_out is not None for r in got)
    empty = {r.score for r in got if not (r.row.text or "").strip()}
    assert len(empty) == 1


def test_held_out_labels_teach_nothing(spark, docs):
    held = [i for i in range(200) if fold(i) == 0]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in held], LABEL)
    model = toxicity.fit(docs([(i, "some text") for i in range(200)]), labels)
    assert model.trees is None and model.base_rate == 0


def test_without_labels_of_both_kinds(spark, docs):
    table = docs([(i, "some text") for i in range(20)])
    for labels in ([], [(1, 1, None), (None, 1, 1)], [(i, 1, 1) for i in range(20)]):
        model = toxicity.fit(table, spark.createDataFrame(labels, LABEL))
        assert {r.score for r in toxicity.score(table, model).collect()} == {model.base_rate}
    assert toxicity.score(docs([]), model).count() == 0


def test_masked_words_count(docs):
    text = "you are an 1d10t and a m.o.r.o.n and s c u m ok"
    row = toxicity.features(docs([(1, text), (2, "you are a good and kind person")]), "text").orderBy("doc_id").collect()
    assert row[0].masked_hit_rate > 0 and row[0].masked_rate > 0
    assert row[1].masked_hit_rate == row[1].masked_rate == row[1].near_rate == 0
    near = toxicity.features(docs([(1, "you big idiot"), (2, "idiot " + "x " * 20 + "you")]), "text").orderBy("doc_id").collect()
    assert near[0].near_rate > 0 and near[1].near_rate == 0


def test_long_unbroken_texts(docs):
    rng = random.Random(3)
    run = "".join(rng.choices("0123456789abcdef", k=200_000))
    pairs = [(1, run), (2, "a-" * 200_000 + "a"), (3, "A.b" * 100_000), (4, "a \U0001d44e " * 50_000), (5, "x" * 200_000), (6, "7" * 200_000)]
    rows = toxicity.features(docs(pairs), "text").orderBy("doc_id").collect()
    assert len(rows) == len(pairs)
    assert [r.masked_rate > 0 for r in rows] == [True, True, True, True, False, False]


def test_masked_patterns_equal_plain_repeats(docs):
    """The possessive patterns find what the plain greedy ones find."""
    masked = r"\p{L}+(?:[\d@$!*._|+\-]+\p{L}+)+|[\d@$!]+\p{L}+(?:[\d@$!*._|+\-]*\p{L}+)*"
    spaced = r"(?<!\p{L})\p{L}(?:[ .*_\-]\p{L}){3,}(?!\p{L})"
    rng = random.Random(4)
    table = docs([(i, "".join(rng.choices("abé1@!.- ", weights=[4, 3, 1, 2, 1, 1, 3, 2, 6], k=rng.randint(0, 60)))) for i in range(4000)])
    for plain, ours in ((masked, toxicity._MASKED), (spaced, toxicity._SPACED)):
        get = lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0))
        got = table.select((get(plain) == get(ours)).alias("same"), F.size(get(ours)).alias("n")).collect()
        assert all(r.same for r in got) and sum(r.n for r in got) > 20
