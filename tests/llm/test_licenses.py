import random
import time

import pytest
from pyspark.sql import functions as F

from omnibus.llm import licenses
from omnibus.llm.common import shingle_hashes


def found(df, **options):
    return sorted(
        ((r.doc_id, r.license, r.coverage, r.first_word, r.last_word) for r in licenses.scan(df, **options).collect()), key=repr
    )


def test_whole_templates_at_any_place(docs):
    rng = random.Random(2)
    pairs, expected = [], []
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        words = licenses_words(text)
        before = rng.randint(0, 300)
        pairs.append((i, "pre " * before + text.upper().replace(" ", "\n", 3) + " post" * 50))
        expected.append((i, name, 1.0, before, before + len(words)))
    got = found(docs(pairs))
    assert set(expected) <= set(got)
    # The Apache header begins with the words of the notice.
    assert {g[:2] for g in got} - {e[:2] for e in expected} == {(4, "Apache-2.0 notice")}


def licenses_words(text):
    import re

    return re.findall(r"\w+", text.lower())


def test_changed_and_partial_texts(docs):
    words = licenses_words(licenses.TEMPLATES["MIT"])
    changed = words[:20] + ["added", "words"] + words[20:60] + words[63:100] + ["other"] + words[101:]
    half = words[: len(words) // 2]
    got = found(docs([(1, " ".join(changed)), (2, " ".join(half)), (3, " ".join(words + ["gap"] * 9 + words))]))
    assert [g[:2] for g in got] == [(1, "MIT"), (3, "MIT"), (3, "MIT")]
    assert got[0][2] == round((len(words) - 4) / len(words), 6)
    assert found(docs([(2, " ".join(half))]), coverage=0.4)[0][2] == round(len(half) / len(words), 6)


def test_alignment_equals_full_table():
    rng = random.Random(6)
    for _ in range(60):
        a = rng.choices("abcdef", k=rng.randint(1, 12))
        b = rng.choices("abcdef", k=rng.randint(0, 15))
        row, best = [0] * (len(b) + 1), 0
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
            row, best = new, max(best, *new)
        matched = licenses.align(a, b, -len(a), len(b))
        assert matched == sorted(set(matched)) and all(0 <= m < len(b) and b[m] in a for m in matched)
        assert len(matched) >= best  # each match scores one at most


def stepwise(template, text, low, high):
    """The alignment cell by cell, as its docstring states it."""
    score, came, best = {}, {}, (0, 0, 0)
    for i in range(1, len(template) + 1):
        for j in range(max(1, i + low), min(len(text), i + high) + 1):
            same = template[i - 1] == text[j - 1]
            options = [(score.get((i - 1, j - 1), 0) + (1 if same else -1), "pair"), (0, "")]
            if j <= i - 1 + high:
                options.append((score.get((i - 1, j), 0) - 1, "skip"))
            if j - 1 >= i + low:
                options.append((score.get((i, j - 1), 0) - 1, "add"))
            score[i, j], came[i, j] = max(options, key=lambda o: o[0])
            if score[i, j] > best[0]:
                best = (score[i, j], i, j)
    _, i, j = best
    matched = []
    while step := came.get((i, j), ""):
        if step == "pair" and template[i - 1] == text[j - 1]:
            matched.append(j - 1)
        i, j = i - (step != "add"), j - (step != "skip")
    return matched[::-1]


def test_alignment_equals_steps_in_any_band():
    rng = random.Random(8)
    for _ in range(400):
        a, b = rng.choices("abcde", k=rng.randint(1, 14)), rng.choices("abcde", k=rng.randint(0, 16))
        low = rng.randint(-len(a) - 2, 4)
        high = low + rng.randint(0, len(a) + len(b))
        assert licenses.align(a, b, low, high) == stepwise(a, b, low, high)


def test_common_words_bound_the_alignment():
    rng = random.Random(9)
    for _ in range(300):
        a, b = rng.choices("abcde", k=rng.randint(1, 14)), rng.choices("abcde", k=rng.randint(0, 16))
        low = rng.randint(-len(a) - 2, 4)
        high = low + rng.randint(0, len(a) + len(b))
        length = {}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                pair = i and j and a[i - 1] == b[j - 1] and low <= j - i <= high
                longest = max(length.get((i - 1, j), 0), length.get((i, j - 1), 0))
                length[i, j] = max(longest, length[i - 1, j - 1] + 1) if pair else longest
        assert licenses.common(a, b, low, high) == length[len(a), len(b)] >= len(licenses.align(a, b, low, high))


def edited(words, share, rng):
    """``words`` with a share of them replaced, left out or followed by another."""
    out = []
    for w in words:
        kind = rng.random() / share
        out += [w] if kind >= 1 else rng.choice([["zz"], [], [w, "zz"]])
    return out


def by_full_table(texts, templates):
    """(text, license) of each best local alignment, over all diagonals, that covers enough."""
    found = set()
    for d, text in texts:
        for name, words in templates.items():
            if licenses.common(words, text, -len(words), len(text)) >= licenses.COVERAGE * len(words) - 1e-9:
                if len(licenses.align(words, text, -len(words), len(text))) >= licenses.COVERAGE * len(words) - 1e-9:
                    found.add((d, name))
    return found


@pytest.mark.parametrize("longest", [120, 6000])
def test_headers_and_full_texts_equal_the_full_table(docs, longest):
    rng = random.Random(longest)
    templates = {n: t for n, t in licenses.library().items() if len(licenses_words(t)) <= longest}
    split = {n: licenses_words(t) for n, t in templates.items()}
    chosen = [n for n in split if longest < 200 or n in ("GPL-3", "LGPL-2.1", "Apache-2.0", "MPL-2.0", "BSD-3-Clause", "GFDL-1.2")]
    texts = []
    for name in chosen:
        texts.append(["pre"] * rng.randint(0, 40) + edited(split[name], rng.choice([0.02, 0.08]), rng) + ["post"] * 20)
    texts += [edited(split[name], 0.6, rng) for name in chosen[:3]]
    expected = by_full_table(list(enumerate(texts)), split)
    got = found(docs([(i, " ".join(t)) for i, t in enumerate(texts)]), templates=templates)
    assert {g[:2] for g in got} == expected and len(expected) >= len(chosen)


def test_full_text_in_bounded_time(spark):
    library = licenses.library()
    templates, places = licenses.index(spark, library)
    words = templates["GPL-3"]
    for text in (words, ["pre"] * 50 + edited(words, 0.03, random.Random(1))):
        hits = hits_of(spark, text, places)
        start = time.perf_counter()
        names = {f[0] for f in licenses.finds(text, hits, templates, places, 0.8)}
        assert {"GPL-3", "GPL-3.0 header"} <= names and time.perf_counter() - start < 10


def test_many_notices_in_one_text(docs):
    got = found(docs([(1, "some words then released under the MIT license " * 20_000)]))
    assert sorted(g[3] for g in got) == [8 * i + 3 for i in range(20_000)]


def hits_of(spark, text, places):
    row = spark.createDataFrame([(text,)], "w array<string>").select(*[shingle_hashes(F.col("w"), k) for k in range(1, 5)]).first()
    return [(i, k, h) for k in range(1, 5) for i, h in enumerate(row[k - 1]) if (k, h) in places]


def test_winnowing_guarantee():
    rng = random.Random(3)
    for _ in range(50):
        hashes = [rng.randrange(10**6) for _ in range(rng.randint(1, 40))]
        places = licenses.winnow(hashes)
        for start in range(max(1, len(hashes) - licenses.WINDOW + 1)):
            assert any(start <= p < start + licenses.WINDOW for p in places)


def test_edge_rows(edge_docs, docs):
    assert found(edge_docs) == []
    assert found(docs([])) == []
    notice = "released under the MIT license"
    assert [g[0] for g in found(docs([(1, notice), (1, notice), (None, notice), (2, None)]))] == [1, 1, None]
    with pytest.raises(ValueError, match="fewer"):
        licenses.scan(docs([]), {"x": "two words"})


def test_one_word_edits_of_short_templates(docs):
    """The scan finds each edited notice that the alignment with all texts accepts."""
    short = {n: licenses_words(t) for n, t in licenses.TEMPLATES.items() if len(licenses_words(t)) <= licenses.SHORT}
    texts = ["licensed under the apache licence version 2 0", "licensed under apache license version 2 0", "released under the mit licence"]
    for words in short.values():
        for i in range(len(words)):
            texts += [" ".join(words[:i] + new + words[i + 1 :]) for new in ([], ["x"], [words[i], "x"], ["x", words[i]])]
    expected = set()
    for d, text in enumerate(texts):
        for name, words in short.items():
            matched = licenses.align(words, text.split(), -len(words), len(text.split()))
            if len(matched) >= licenses.COVERAGE * len(words) - 1e-9:
                expected.add((d, name))
    assert {0, 1, 2} <= {d for d, _ in expected} and len(expected) > 100
    templates = {n: licenses.TEMPLATES[n] for n in short}
    assert {g[:2] for g in found(docs(list(enumerate(["pre fix " + t + " and so on" for t in texts]))), templates=templates)} >= expected


def test_more_fingerprints_than_fit_are_scanned_in_parts(docs, monkeypatch):
    pairs = list(enumerate(licenses.TEMPLATES.values()))
    whole = found(docs(pairs))
    monkeypatch.setattr(licenses, "MAX_FINGERPRINTS", 50)
    assert found(docs(pairs)) == whole


def test_every_plan_fits_the_guaranteed_run():
    for n in range(4, 400):
        k, window = licenses.plan(n, 0.8)
        missing = int(0.2 * n + 1e-9)
        assert 1 <= k <= n and (missing + 1) * (k + window - 2) < n - missing


def test_library_finds_each_of_its_texts(docs):
    library = licenses.library()
    assert {"BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "LGPL-2.1", "AGPL-3.0 header", "GPL-2", "Unlicense", "BSL-1.0"} <= set(library)
    short = {n: t for n, t in library.items() if len(t) < 4000}
    got = found(docs([(i, "pre fix " + t + " post") for i, t in enumerate(short.values())]), templates=library)
    assert {(i, n, 1.0) for i, n in enumerate(short)} <= {g[:3] for g in got}
