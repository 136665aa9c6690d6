import math
import random
import re

from omnibus.llm import decontamination

ITEM = "item_id bigint, text string, doc_id string"


def grams(text):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(docs, items, limit=0.8):
    out = []
    for d, text in docs:
        best = {}
        for i, item in items:
            g = grams(item)
            shared = len(g & grams(text))
            if g and shared >= limit * len(g) - 1e-9:
                best[i] = max(best.get(i, (0, 0, 0)), (shared / len(g), len(g), shared))
        out += [(d, i, n, shared) for i, (_, n, shared) in best.items()]
    return sorted(out, key=repr)


def test_equals_brute_force(spark, docs):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 5, 6, 12, 30, 80, 200])))) for i in range(40)]
    texts = []
    for d in range(150):
        body = rng.choices(words, k=rng.randint(0, 300))
        if d % 2:
            part = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = part[: rng.randint(max(1, len(part) - 8), len(part))]
        texts.append((d, rng.choice([" ", ", ", "\n"]).join(body).title()))
    # Some ids stand for several texts, two of them held by one document.
    items = [(i % 30, text) for i, text in items]
    texts.append((900, f"{items[3][1]} between {items[33][1]} {items[13][1]}"))
    texts += [(901 + k, items[k][1].upper()) for k in range(20)] + [(950, items[5][1])] * 2
    got = decontamination.contained(docs(texts), spark.createDataFrame([(*i, None) for i in items], ITEM))
    rows = sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got.collect()), key=repr)
    assert rows == brute(texts, items) and len(rows) >= 20


def test_edge_rows(spark, edge_docs):
    long = " ".join(f"word{i}" for i in range(100, 140))
    items = spark.createDataFrame(
        [(1, long, None), (2, None, None), (3, "", None), (4, "two words", None), (None, "stands here twice or more", None),
         (6, "and the same text stands", None), (6, "same text stands here twice", None), (6, "of an other text with this id", None),
         (1, long, None), (8, "--", None), (9, "stands here", None)],
        ITEM,
    )
    got = decontamination.contained(edge_docs, items)
    rows = sorted(((r.doc_id, r.item_id) for r in got.collect()), key=repr)
    same = [(5, 6), (6, 6), (6, 6), (None, 6), (5, None), (6, None), (6, None), (None, None)]
    # A short item is held by the text of its words, and not by texts with more.
    assert rows == sorted([(4, 1), (9, 1), (7, 4), *same], key=repr)
    kept = decontamination.clean(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 2, 3, None, 8]))


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEM)
    assert decontamination.contained(docs([]), none).count() == 0
    assert decontamination.clean(docs([(1, "a b c d e f")]), none).count() == 1


def test_only_built_in_operators(spark, docs):
    items = spark.createDataFrame([(1, "a b c d e f g", None)], ITEM)
    plan = decontamination.contained(docs([(1, "x a b c d e f g")]), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_two_texts_of_one_item_give_one_row(spark, docs):
    items = spark.createDataFrame([(7, "a b c d e f g", None), (7, "h i j k l m n o p", None)], ITEM)
    got = decontamination.contained(docs([(1, "x a b c d e f g and h i j k l m n o p")]), items).collect()
    assert [(r.doc_id, r.item_id, r.n_item, r.containment) for r in got] == [(1, 7, 5, 1.0)]


def test_bitmap_keeps_all_that_can_hit(spark, monkeypatch):
    rng = random.Random(7)
    some = [rng.randrange(-(2**63), 2**63) for _ in range(3000)]
    hashes = spark.createDataFrame([(h,) for h in some], "hash bigint")
    lookup = spark.createDataFrame([(h,) for h in some[::3]], "hash bigint")
    kept = {r.hash for r in decontamination.may_hit(hashes, lookup).collect()}
    assert set(some[::3]) <= kept and len(kept) < 1010
    # With few words nearly all pass, and none that has a partner is lost.
    monkeypatch.setattr(decontamination, "WORD_BITS", 2)
    assert set(some[::3]) <= {r.hash for r in decontamination.may_hit(hashes, lookup).collect()}


def test_sample_finds_items_at_the_threshold():
    for low in (1, 9, 17, 100):
        assert decontamination.sample_size(low, 0.8) <= 16
    assert 0.2 ** decontamination.sample_size(1000, 0.8) <= 1e-6


def test_each_partition_has_its_own_sample_size():
    ranges = [*zip((0, *decontamination.SIZES), decontamination.SIZES)]
    sizes = [decontamination.sample_size(low + 1, 0.8, largest=high) for low, high in ranges]
    assert sizes == sorted(sizes) and sizes[0] < sizes[2] < 9 and sizes[-1] <= 9
    for (low, high), k in zip(ranges, sizes):
        for n in range(low + 1, high + 1):
            missing = n - math.ceil(0.8 * n - 1e-9)
            assert math.comb(missing, k) <= (1e-6 + 1e-15) * math.comb(n, k) if k <= n else True
