import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultfeed.llm import queries, tokens


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


def brute(text, library, sections):
    """Tokens and crossing tokens of every section, token by token; the last entry is for tokens in no section."""
    char, chars = -1, []
    for b in text.encode():
        char += (b & 0xC0) != 0x80
        chars.append(char)
    at, out = 0, [[0, 0] for _ in range(len(sections) + 1)]
    for size in (len(library.decode_single_token_bytes(i)) for i in library.encode_ordinary(text)):
        start, end = chars[at], chars[at + size - 1] + 1
        at += size
        common = [min(end, e) - max(start, s) for _, s, e in sections]
        best = max(range(len(common)), key=lambda k: (common[k], -k), default=-1)
        if best < 0 or common[best] <= 0:
            out[-1][0] += 1
        else:
            out[best][0] += 1
            out[best][1] += start < sections[best][1] or end > sections[best][2]
    return out


def test_allocation_rule():
    s, e = np.array([0, 3, 10]), np.array([3, 5, 12])
    owner, crossing = tokens.allocate(np.array([0, 2, 2, 4, 5, 9, 1]), np.array([2, 4, 5, 6, 9, 11, 12]), s, e)
    assert owner.tolist() == [0, 0, 1, 1, -1, 2, 0] and crossing.tolist() == [False, True, True, True, False, True, True]


def test_paragraphs_cover_the_text():
    for text in ("", "a", "a\n", "\n\n", "a\nb\n\n- c"):
        spans = tokens.paragraphs(text)
        assert "".join(text[a:b] for _, a, b in spans) == text and spans[-1][2] == len(text)


def thirds():
    def sections(text):
        n = len(text) // 3
        return [("head", 0, n), ("empty", n, n), ("tail", 2 * n, len(text))]

    return sections


@pytest.mark.parametrize("sections", [tokens.paragraphs, thirds(), lambda _: []])
def test_awkward_rows(awkward, library, vocabulary, sections):
    got = {}
    for r in tokens.counts(awkward.where("doc_id is null or doc_id <> 6"), vocabulary, sections).collect():
        got.setdefault(r.doc_id, {})[r.section] = [r.n_tokens, r.n_crossing]
    for row in awkward.where("doc_id is null or doc_id <> 6").collect():
        text = row.text or ""
        want = dict(enumerate(brute(text, library, sections(text))))
        rest = want.pop(len(want) - 1)
        assert got.get(row.doc_id, {}) == want | ({-1: rest} if rest[0] else {})


@settings(max_examples=30, deadline=None)
@given(texts=st.lists(st.text("ab\n 日👍é.", max_size=30), min_size=1, max_size=6))
def test_random_texts(spark, library, vocabulary, texts):
    got = {}
    for r in tokens.counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), vocabulary).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.n_tokens, r.n_crossing))
    for k, text in enumerate(texts):
        spans = tokens.paragraphs(text)
        counted = brute(text, library, spans)
        assert sorted(got[k]) == [(i, a, b, *counted[i]) for i, (_, a, b) in enumerate(spans)]


def test_repeated_rows_empty_and_clashing(awkward, empty, clashing, vocabulary):
    assert tokens.counts(awkward.where("doc_id = 6"), vocabulary).count() == 2
    assert tokens.counts(empty, vocabulary).count() == 0
    assert tokens.counts(clashing, vocabulary).count() == 5


def test_query(spark, sf, documents, library):
    got = {}
    for r in queries.op6_token_counts(spark, sf).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == {i: len(library.encode_ordinary(t or "")) for i, t in documents}
