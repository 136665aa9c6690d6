import random
import re
from collections import defaultdict

import numpy as np
import pytest

from omnibus.llm import ngram_join
from omnibus.llm.common import components

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute(pairs, size=5, similarity=0.8):
    """One row (doc_id, class_id, n_links) per input row, from all pairs."""
    sets = []
    for _, text in pairs:
        w = re.findall(r"\w+", (text or "").lower())
        n = min(size, len(w)) or 1
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    near = defaultdict(set)
    for a in range(len(pairs)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
                near[a].add(b)
                near[b].add(a)
    out = []
    for a in range(len(pairs)):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [pairs[i][0] for i in seen if pairs[i][0] is not None]
        out.append((pairs[a][0], min(ids) if ids else None, len(near[a])))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(df).collect()), key=repr)


def copies(seed, groups, per_group, words=40):
    """Random texts with exact copies and copies of few to many changed words."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    pairs = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(5, words))
        for _ in range(rng.randint(1, per_group)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            pairs.append((len(pairs), " ".join(text)))
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 7])
def test_equals_all_pairs(docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    pairs = copies(3, 25, 12)
    assert found(docs(pairs)) == brute(pairs)


def test_long_chain_and_large_group(docs):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(60)]
    pairs = []
    for i in range(120):  # each a small step from the one before
        base[rng.randrange(60)] = f"n{i}"
        pairs.append((i, " ".join(base)))
    assert found(docs(pairs)) == brute(pairs)


def test_edge_rows(edge_docs):
    pairs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert found(edge_docs) == brute(pairs)


def test_empty_table(docs):
    assert ngram_join.join(docs([])).count() == 0
    assert ngram_join.one_of_each(docs([])).count() == 0


def test_one_of_each_keeps_rows_as_they_are(edge_docs):
    kept = ngram_join.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    # 4 and 9 are alike, as are 5, 6, 6 and NULL; rows without words stand alone.
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 2, 3, 4, 5, None, 7, 8]))


def test_one_of_each_leaves_one_of_a_repeated_row(docs):
    text = "a row that is there twice as a whole"
    kept = ngram_join.one_of_each(docs([(5, text), (5, text), (9, text), (2, "another text of six words here")]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5]


def test_plan_bands_reaches_recall():
    for similarity in (0.5, 0.8, 0.95):
        bands, rows = ngram_join.plan_bands(similarity)
        assert 1 - (1 - similarity**rows) ** bands >= ngram_join.RECALL
        assert bands * rows <= ngram_join.MAX_HASHES


def test_recall_of_pairs_near_the_threshold(spark):
    """Of random set pairs just above the threshold nearly all share a band."""
    rng = np.random.default_rng(5)
    rows, expected = [], 300
    for i in range(expected):
        common = [f"c{i}x{k}" for k in range(54)]
        # 50 shingles of the shared run; one changed word at the end takes away five at most.
        other = common[:-1] + [f"o{i}"]
        rows += [(2 * i, " ".join(common)), (2 * i + 1, " ".join(other))]
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(i), str(t), "en", "s", 1) for i, t in rows], DOC)
    linked = sum(r.n_links == 1 for r in ngram_join.join(df).collect())
    assert linked == 2 * expected


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(64)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    root = {}

    def head(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((head(a), head(b)))
        root[y] = x
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: head(x) for x in nodes if head(x) != x}


def test_blocks_are_bounded_by_their_grams(spark, docs, monkeypatch):
    """Large sets are spread over more blocks, levels that can't be similar aren't paired, and no link is lost."""
    rows = [("r", f"k{i}".encode(), 10 + 90 * (i % 2), i % 2 * 10, 1, b"") for i in range(400)]
    members = spark.createDataFrame(rows, "root string, set_key binary, n_grams bigint, level bigint, copies bigint, row_key binary")
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 1000)
    blocks = defaultdict(list)
    for r in ngram_join.blocked(members).collect():
        blocks[r.block].append(r)
    held = {b: sum(10 + 90 * (int(r.set_key[1:]) % 2) for r in own) for b, own in blocks.items()}
    assert len(blocks) > 15 and max(held.values()) <= 3000
    assert all(len(r.near) == 1 for own in blocks.values() for r in own)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 60)
    pairs = copies(7, 12, 12)
    assert found(docs(pairs)) == brute(pairs)
