import zlib

import numpy as np
import pytest

from vaultfeed.llm import language, queries

from .conftest import ID_TEXT


def kernel(a, b):
    return len(set(a) & set(b)) / max(1, len(a) * len(b)) ** 0.5


def test_presence_ignores_counts_case_and_symbols():
    one = language.present("Ab, ab! AB 12 ab")
    assert (one == language.present("ab ab")).all() and not len(language.present("12 ?")) and not len(language.present(None))


def test_kernels_with_landmarks_are_presence_kernels():
    texts = {"en": ["the cat sat", "on the mat then"], "de": ["die katze saß", "auf der matte"]}
    sample = [(g, language.present(t)) for g, ts in texts.items() for t in ts]
    model = language.solve(sample)
    marks = [s for g in sorted(texts) for h, s in sample if h == g]
    want = np.array([[kernel(s, m) for m in marks] for _, s in sample])
    assert np.allclose(model.kernel([s for _, s in sample]), want, atol=1e-5)
    assert [model.languages[k] for k in model.scores([s for _, s in sample]).argmax(axis=1)] == [g for g, _ in sample]


@pytest.fixture(scope="module")
def judged(spark, sf):
    return {r.doc_id: r for r in queries.op1_language(spark, sf).collect()}


def test_held_out_by_checksum(judged):
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in judged.items())


def test_accuracy_on_held_out_documents(judged, con):
    rows = con.sql("select doc_id, lang, text from documents where lang is not null and text is not null").fetchall()
    rows = [(i, g) for i, g, t in rows if any(c.isalpha() for c in t) and judged[i].held_out]
    assert np.mean([judged[i].lang_pred == g for i, g in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in judged.values())


def test_every_language_is_learned(spark, monkeypatch):
    dice = np.random.default_rng(3)
    rows = []
    for g in range(90):
        vocabulary = ["".join(map(chr, dice.integers(0x4E00 + 40 * g, 0x4E00 + 40 * g + 40, 3))) for _ in range(12)]
        rows += [(100 * g + k, " ".join(dice.choice(vocabulary, 15)), f"g{g:02}") for k in range(4 + 12 * (g % 2))]
    docs = spark.createDataFrame(rows, ID_TEXT + ", lang string")
    want = {i: g for i, _, g in rows}
    model = language.fit(docs)
    assert len(model.languages) == len({want[i] for i in want if zlib.crc32(str(i).encode()) % 4 != 2}) == 90
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert np.mean([got[i] == want[i] for i in want]) > 0.97
    monkeypatch.setattr(language, "SAMPLE", 180)
    monkeypatch.setattr(language, "MARKS", 60)
    small = language.fit(docs)
    assert len(small.languages) == 90 and small.matrix.shape[1] == 60


def test_only_the_text_is_read(spark, sf):
    docs = queries.table(spark, sf, "documents")
    model = language.fit(docs)
    one = docs.where("text is not null").limit(20)
    other = one.selectExpr("doc_id + 1000 as doc_id", "text", "'xx' as lang", "'s' as source")
    assert sorted(r.lang_pred for r in language.predict(one, model).collect()) == sorted(r.lang_pred for r in language.predict(other, model).collect())


def test_awkward_rows(spark, awkward, empty, clashing):
    lang = awkward.selectExpr("doc_id", "text", "if(doc_id > 7, 'b', 'a') as lang")
    got = language.judged(lang).collect()
    assert len(got) == 10 and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    nothing = language.judged(lang.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and {r.score for r in nothing} == {0.0}
    assert language.judged(empty.selectExpr("*", "'a' as lang")).count() == 0
    assert language.judged(clashing.selectExpr("*", "'a' as lang")).count() == 5
    assert spark.createDataFrame([], ID_TEXT).count() == 0


def test_copies_take_no_other_texts_place(spark):
    """16 texts of a language, one of them 2,000 times: all of them are learned."""
    texts = [f"text number {chr(97 + k) * 3} of the language" for k in range(16)]
    rows = [(i, texts[i % 16 if i < 160 else 0], "en") for i in range(2160)] + [(10_000 + i, f"autre {chr(97 + i)}", "fr") for i in range(20)]
    model = language.fit(spark.createDataFrame(rows, ID_TEXT + ", lang string"), held=False)
    assert model.matrix.shape[1] == 16 + 20


def test_predictions_equal_plain_kernels(spark, sf, judged, con):
    """Every prediction from sets of n-grams and the learned weights, one text after the other."""
    docs = queries.table(spark, sf, "documents")
    model = language.fit(docs)
    used = np.flatnonzero(model.slot >= 0)
    marks = [set(used[model.matrix[:, k] > 0].tolist()) for k in range(model.matrix.shape[1])]
    for i, text in con.sql("select doc_id, text from documents order by doc_id limit 60").fetchall():
        own = set(language.present(text).tolist())
        scores = np.array([len(own & m) / (len(own) * len(m)) ** 0.5 for m in marks] + [1.0]) @ model.weights if own else None
        assert judged[i].lang_pred == ("und" if scores is None else model.languages[int(scores.argmax())])
