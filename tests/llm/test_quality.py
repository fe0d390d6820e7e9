import random

import numpy as np
import pyarrow as pa
import pytest

from vaultfeed.llm import quality, queries

from .conftest import ID_TEXT


def test_features_are_distinct_words_of_whole_texts():
    texts = ["A b a", "", None, "b", "a B!"]
    rows, cols = quality.features(pa.array(texts))
    words = cols < quality.SLOTS - 64
    per = [set(cols[(rows == k) & words].tolist()) for k in range(5)]
    assert [len(p) for p in per] == [2, 0, 0, 1, 2] and per[0] == per[4] and per[3] < per[0]
    assert all((rows[~words] == k).sum() == 5 for k in range(5))


def test_a_batch_gives_what_single_texts_give():
    texts = ["The first, longer text", "é ünicode WORDS here", "x" * 50, " ", "The first"]
    model = quality.Model(np.sin(np.arange(quality.SLOTS)), np.array([-1.0, 1.0]))
    together = quality.scores(pa.array(texts), model)
    assert np.allclose(together, [quality.scores(pa.array([t]), model)[0] for t in texts])


def sample(n, seed=1):
    dice = random.Random(seed)
    words = [f"word{k}" for k in range(300)]
    bad, worse = ["junk1", "junk2", "junk3"], ["awful1", "awful2"]
    out = []
    for k in range(n):
        grade = dice.choice((0, 1, 2, 2, 2))
        extra = [dice.choice(bad)] * (grade < 2) + [dice.choice(worse)] * (grade < 1)
        ws = dice.choices(words, k=60) + extra
        dice.shuffle(ws)
        out.append((k, " ".join(ws), grade))
    return out


def test_ordinal_model_learns_the_order(spark):
    docs = sample(900)
    frame = spark.createDataFrame([d[:2] for d in docs], ID_TEXT)
    labels = spark.createDataFrame([(i, int(g == 2), int(g == 0)) for i, _, g in docs[:700]], "doc_id long, quality int, toxic int")
    model = quality.fit(frame, labels)
    assert model.cuts[0] < model.cuts[1]
    got = {r.doc_id: r for r in quality.rate(frame, model).collect()}
    fresh = docs[700:]
    assert np.mean([got[i].keep == (g == 2) for i, _, g in fresh]) > 0.97
    means = [np.mean([got[i].expected_grade for i, _, g in fresh if g == k]) for k in (0, 1, 2)]
    assert means[0] < means[1] < means[2]
    assert sorted(r.doc_id for r in quality.select(frame, model).collect()) == sorted(i for i, r in got.items() if r.keep)


def test_the_gradient_fits_the_likelihood():
    rated = sorted((g, np.array(sorted({k % 7, 20 + g}), "<i4").tobytes()) for k, g in enumerate([0, 1, 2] * 60))
    model = quality.solve(rated)
    scores = [sum(model.weights[c] / 2**0.25 for c in (0, 20 + g)) for g in range(3)]
    assert scores[0] < scores[2] and 0 < model.beyond(np.array(scores))[2, 1] <= 1


def test_sample_is_bounded(spark):
    docs = sample(400)
    frame = spark.createDataFrame([d[:2] for d in docs], ID_TEXT)
    labels = spark.createDataFrame([(i, int(g == 2), 0) for i, _, g in docs], "doc_id long, quality int, toxic int")
    assert quality.fit(frame, labels, sample=50).cuts.shape == (2,)


def test_awkward_rows(spark, awkward, empty, clashing):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 1, None), (None, 1, 0), (9, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(awkward, labels)
    got = quality.rate(awkward, model).collect()
    assert len(got) == 10 and all(0 <= r.p_top <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    assert len({r.p_top for r in got if r.doc_id in (1, 2)}) == 1 and len({r.p_top for r in got if r.doc_id in (5, 6, None)}) == 1
    blank = quality.fit(awkward, labels.limit(0))
    assert {r.p_top for r in quality.rate(awkward, blank).collect()} == {0.5}
    assert quality.rate(empty, model).count() == 0 and quality.rate(clashing, model).count() == 5
    assert set(quality.select(clashing, blank).columns) == set(clashing.columns)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_on_labelled_documents(spark, con, folder):
    got = {r.doc_id: r.keep for r in queries.op10_quality(spark, folder).collect()}
    rows = con.sql(f"select doc_id, quality, toxic from '{folder}/labels.parquet'").fetchall()
    assert len(got) == 1000
    assert np.mean([got[i] for i, q, t in rows if q and not t]) > 0.97
    assert np.mean([got[i] for i, q, t in rows if t]) < 0.3  # a few dozen toxic documents to learn from


def test_the_sample_is_bounded(spark, monkeypatch):
    """One id on 3,000 rows, of two texts and of as many: at most the sample's rows reach the driver."""
    seen = []
    monkeypatch.setattr(quality, "solve", lambda rated: seen.append(len(rated)) or quality.Model(np.zeros(quality.SLOTS), np.zeros(2)))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    few = [(i, f"text {i}") for i in range(40)]
    for copies, want in (([(7, f"text {k % 2}") for k in range(3000)], 42), ([(7, f"text {k}") for k in range(3000)], 50)):
        quality.fit(spark.createDataFrame(few + copies, ID_TEXT), labels, sample=50)
        assert seen.pop() == want
