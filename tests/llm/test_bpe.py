import hashlib
import struct
import unicodedata
from array import array

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from omnibus.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.WordBpe.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


TEXTS = st.text(st.one_of(st.characters(max_codepoint=0x52F), st.sampled_from("Σςİß中あ가😀́ 　½²'<|>")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_and_text_equal_the_library(vocabulary, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert list(array("I", vocabulary.encode(text))) == ids
    assert vocabulary.decode(vocabulary.encode(text)).decode() == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", "a", "ab" * 5000, "aaaa" * 700 + " b", "<|endoftext|>x<|startoftext|>", "<|endoftext|", "it's We'LL 12½", "x\x00y"],
)
def test_special_and_long(vocabulary, library, text):
    assert list(array("I", vocabulary.encode(text))) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeinthrs", min_size=1, max_size=64))
def test_heap_and_scan_merge_alike(vocabulary, word):
    assert vocabulary.merge(vocabulary.parts(word)) == vocabulary.merge_long(vocabulary.parts(word))


def test_digests(spark, edge_docs, vocabulary, library):
    got = bpe.digests(edge_docs, vocabulary)
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    expected = []
    for r in edge_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        )
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_encoded_round_trip(docs, vocabulary):
    rows = bpe.encoded(docs([(1, "The  Cat\nsat."), (2, None)]), vocabulary).orderBy("doc_id").collect()
    assert rows[0].decoded == "the</w> cat</w> sat</w> .</w>" and vocabulary.decode(bytes(rows[0].ids)).decode() == rows[0].decoded
    assert bytes(rows[1].ids) == b"" and rows[1].decoded == ""


def test_empty_table(docs, vocabulary):
    assert bpe.digests(docs([]), vocabulary).count() == 0


MARKS = [c for c in map(chr, range(0x110000)) if unicodedata.combining(c)]


def test_every_mark_stands_where_the_library_puts_it(vocabulary, library):
    # Before and after marks of the lowest, a middle and the highest class, and one that composes.
    texts = [t for c in MARKS for o in "̴̧́ͅ" for t in (f"a{c}{o}", f"a{o}{c}", f"e{o}{c}́")]
    texts += ["\U00011935\U00011930", "\U00011938́", "a࢜́ͅ"]
    for text in texts:
        assert list(array("I", vocabulary.encode(text))) == library.encode(text, add_special_tokens=False).ids, text.encode("unicode_escape")


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(MARKS), st.sampled_from("aeoक가각 ")), max_size=12))
def test_random_marks_equal_the_library(vocabulary, library, text):
    assert list(array("I", vocabulary.encode(text))) == library.encode(text, add_special_tokens=False).ids
