import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultfeed.llm import bpe, queries

from .conftest import sha


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


def test_the_hash_is_perfect_and_minimal(vocabulary):
    assert sorted(vocabulary.slots.tolist()) == list(range(len(vocabulary.tokens)))
    assert vocabulary.find(vocabulary.tokens[:500]) == list(range(500))
    assert vocabulary.find([b"no such token in the vocabulary", b""]) == [-1, -1]


def test_small_and_empty_vocabularies():
    assert bpe.Vocabulary.of({}, ".").find([b"a"]) == [-1]
    assert bpe.Vocabulary.of({b"a": 0}, ".").find([b"a", b"b"]) == [0, -1]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab '\x1c\x85\xa0　\n\r\tT1²é日👍stdrvlm_!?"), max_size=20))
def test_same_ids_as_the_library(library, vocabulary, text):
    ids = bpe.Encoder(vocabulary).encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_a_general_pattern_splits_as_the_known_one(vocabulary):
    import regex

    text = "It's 12 o'clock,  we'll\n\n go-to \x1c 　x"
    assert regex.findall(bpe.explicit(bpe.KNOWN), text) == bpe.split(text)


def test_memo_is_bounded(monkeypatch, library, vocabulary):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 5 * bpe.ENTRY_BYTES)
    encoder = bpe.Encoder(vocabulary)
    for text in ("one two three four", "five six one two", "seven eight nine ten eleven twelve", "one"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        assert len(encoder.memo) <= 5 + len(encoder.split(text))


def test_awkward_rows(awkward, library, vocabulary):
    got = sorted(map(tuple, bpe.digests(awkward, vocabulary).collect()), key=str)
    want = []
    for i, t in ((r.doc_id, r.text) for r in awkward.collect()):
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t or "")))
    assert got == sorted(want, key=str)


def test_empty_and_clashing(empty, clashing, vocabulary):
    assert bpe.digests(empty, vocabulary).count() == 0
    assert bpe.digests(clashing, vocabulary).count() == 5


def test_query(spark, sf, documents, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_bpe_roundtrip(spark, sf).collect()}
    for i, t in documents:
        ids = library.encode_ordinary(t or "")
        assert got[i] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t or ""))
