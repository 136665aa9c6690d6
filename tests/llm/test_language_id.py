import random
import zlib

import numpy as np
import pytest

from omnibus.llm import language_id as lid
from omnibus.llm.common import table

WORDS = {
    "en": "the and with that from have this which would there their about other after".split(),
    "de": "der die und nicht eine durch über wäre schön straße zwischen möchte haben".split(),
    "el": "και της στην είναι από που για δεν θα τους αυτό μια όπως".split(),
}


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(2, 30))), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, "s", 0, None, None, None) for i, t, lang in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, h string, gram string",
    )


def plain_grams(text):
    """Every n-gram of a text, by slicing strings."""
    shown = "".join(c if lid._kinds()[ord(c)] else " " for c in text.lower())
    shown = " " + " ".join(shown.split()) + " "
    found = []
    for order in range(1, lid.LONGEST + 1):
        for i in range(len(shown) - order + 1):
            g = shown[i : i + order]
            inner = g[1:-1] if order > 2 else ""
            if " " not in inner and g.strip():
                found.append(g)
    return found


@pytest.mark.parametrize("text", ["A", "ab cd", "Über, die!! straße... x", " a1b ", "और यह ठीक है", "x" * 50])
def test_ngrams_equal_slices(text):
    code = lid.codes(text)
    got = [h for part, _ in lid.grams(code, 0, len(code)) for h in part.tolist()]
    want = plain_grams(text)
    assert len(got) == len(want)
    # Equal slices have equal hashes and different ones do not.
    assert len(set(got)) == len(set(want)) == len(set(zip(got, sorted(want, key=len))))


def test_windows_change_nothing(monkeypatch):
    text = " ".join(t for _, t, _ in corpus())
    code = lid.codes(text)
    whole = sorted(h for part, _ in lid.grams(code, 0, len(code)) for h in part.tolist())
    cut = [h for s in range(0, len(code), 7) for part, _ in lid.grams(code, s, min(s + 7, len(code))) for h in part.tolist()]
    assert sorted(cut) == whole


def test_filters_equal_plain_sets(spark):
    rows = [r for r in corpus() if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = lid.fit(frame(spark, rows))
    assert set(model.languages) == set(WORDS)
    # The n-grams of each language by the stated rule, over its different texts.
    texts = {lang: {t for _, t, x in rows if x == lang} for lang in WORDS}
    shares = {}
    for lang, held in texts.items():
        counts = {}
        for t in held:
            for g in set(plain_grams(t)):
                counts[g] = counts.get(g, 0) + 1
        for g, n in counts.items():
            if n >= lid.SUPPORT:
                shares.setdefault(g, {})[lang] = n / len(held)
    members = {lang: set() for lang in WORDS}
    for g, by in shares.items():
        for lang, share in by.items():
            if share >= lid.CONTRAST * max(by.values()):
                members[lang].add(g)
    for text in [t for _, t, _ in corpus(seed=9)][:40]:
        total, hits = lid.counts(model, [text])
        grams = plain_grams(text)
        assert total[0] == len(grams)
        for i, lang in enumerate(model.languages):
            # A filter never loses a member, and lets few others through.
            exact = sum(g in members[lang] for g in grams)
            assert exact <= hits[0, i] <= exact + 3


def test_counts_do_not_depend_on_the_batch(spark):
    model = lid.fit(frame(spark, corpus()))
    texts = [t for _, t, _ in corpus(seed=3)] + [None, "", "1234", "x " * 60_000, corpus(seed=4)[0][1] * 3000]
    total, hits = lid.counts(model, texts)
    for i, t in enumerate(texts):
        one, mine = lid.counts(model, [t])
        assert one[0] == total[i] and (mine[0] == hits[i]).all()


def test_correction_takes_off_what_chance_lets_through():
    model = lid.Model(("a", "b"), np.zeros((1, lid.POSITIONS), np.uint64), np.array([0.5, 0.01]))
    # 60 of 100 against a filter half full are 20, 30 of 100 against an empty one nearly 30.
    names, score = lid.decide(model, np.array([100]), np.array([[60, 30]]))
    assert names == ["b"] and score[0] == pytest.approx(29.2929 / (20 + 29.2929), 1e-4)


def test_more_languages_than_one_word_has_bits(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"{letters[k % 26]}{letters[k // 26]}{letters[(k * 7) % 26]} " * 4 + str(j), f"l{k:02d}")
            for i, (k, j) in enumerate((k, j) for k in range(70) for j in range(6))]
    model = lid.fit(frame(spark, rows))
    assert len(model.languages) == 70 and model.table.shape[0] == 2
    got = lid.predict(frame(spark, rows), model).collect()
    assert sum(r.lang_pred == lang for r, (_, _, lang) in zip(sorted(got), rows)) > 400


def test_edge_rows(spark):
    learned = corpus()
    odd = [
        (1000, None, "en"), (1001, "", "en"), (1002, "12 ... !", "de"), (1003, "the and with", None), (None, "και της", None),
        (1004, "漢字", None), (1005, " ".join(WORDS["de"] * 20_000), None), (1005, " ".join(WORDS["de"] * 20_000), None),
    ]
    model = lid.fit(frame(spark, learned + odd))
    got = lid.predict(frame(spark, odd), model)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
    assert [by_id[i][0].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "el"]
    assert [by_id[i][0].score for i in (1000, 1001, 1002, 1004)] == [0, 0, 0, 0]
    assert by_id[1004][0].lang_pred == model.languages[0]
    assert [r.lang_pred for r in by_id[1005]] == ["de", "de"]


def test_nothing_learned(spark):
    empty = frame(spark, [])
    model = lid.fit(empty)
    assert model.languages == () and lid.predict(empty, model).count() == 0
    assert [r.lang_pred for r in lid.predict(frame(spark, corpus(3)), model).collect()] == ["und"] * 3


def test_held_out_rows_teach_nothing(spark):
    rows = corpus()
    other = [(i, t, lang if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i, t, lang in rows]
    first, second = lid.fit(frame(spark, rows)), lid.fit(frame(spark, other))
    assert first.languages == second.languages and (first.table == second.table).all()


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in lid.predict(docs, lid.fit(docs)).collect() if r.held_out]
    assert len(got) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.99 * len(got)
