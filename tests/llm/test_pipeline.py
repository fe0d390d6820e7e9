import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from vaultfeed.llm import neardup, quality, queries, secrets
from vaultfeed.llm.common import written

from .test_decontaminate import WORD, words
from .test_neardup import brute as near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark, sf):
    """The documents, and rows of awkward kinds beside them."""
    item = queries.table(spark, sf, "benchmark").orderBy("item_id").first().text
    clean = " ".join(f"plain{k} word" for k in range(60))
    rows = [
        (900, None), (901, ""), (902, item), (903, f"{clean} {item} {clean}"), (904, f"{clean} {item} {clean}"),
        (905, clean + ' KEY = "zK8pQ2mN4vX7"\nclient_secret = KEY, password=hunter2hunter2'), (906, clean), (906, clean), (None, clean),
    ]
    extra = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return written(queries.table(spark, sf, "documents").select(COLUMNS).unionByName(extra), "docs")


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def cut(text, items, most=0.5):
    """The text without words that windows of items cover, or nothing if most of it is covered."""
    ws, hit = words(text), set()
    for n, item in items:
        at = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)}
        hit.update(p for k in range(len(ws) - n + 1) if tuple(ws[k : k + n]) in at for p in range(k, k + n))
    if len(hit) > most * len(ws):
        return None
    spans = [m.span() for m in WORD.finditer(text.translate({c: c + 32 for c in range(65, 91)}))]
    for p in sorted(hit, reverse=True):
        end = spans[p][1] if p + 1 not in hit else spans[p + 1][0]
        text = text[: spans[p][0]] + text[end:]
    return text


def test_stages_are_the_five_in_order():
    assert list(STAGES) == ["quality", "near_duplicates", "decontaminate", "secrets", "encode"]


def test_quality(spark, sf, docs):
    got = STAGES["quality"](spark, docs, sf)
    model = quality.fit(docs, queries.table(spark, sf, "labels"))
    want = [d for d in texts(docs) if model.beyond(quality.scores(pa.array([d[1]], pa.string()), model))[0, -1] >= quality.KEEP]
    assert got.columns == COLUMNS and texts(got) == want


def test_near_duplicates(spark, sf, docs):
    got = STAGES["near_duplicates"](spark, docs, sf)
    named = {i: t for i, t in texts(docs) if i is not None}
    kept = {i for i, (_, _, keep) in near_duplicates(named.items(), neardup.Rule()).items() if keep}
    want = [(i, t) for i, t in named.items() if i in kept] + [d for d in texts(docs) if d[0] is None]
    assert got.columns == COLUMNS and texts(got) == sorted(want, key=str)


def test_decontaminate(spark, sf, docs):
    got = STAGES["decontaminate"](spark, docs, sf)
    items = [words(r.text) for r in queries.table(spark, sf, "benchmark").collect()]
    items = [(min(10, len(i)), i) for i in items if i]
    want = [(i, t if t is None else cut(t, items)) for i, t in texts(docs)]
    want = [w for w, d in zip(want, texts(docs), strict=True) if w[1] is not None or d[1] is None]
    assert got.columns == COLUMNS and texts(got) == sorted(want, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert 902 not in {i for i, _ in want} and 903 in {i for i, _ in want}


def test_secrets(spark, sf, docs):
    got = STAGES["secrets"](spark, docs, sf)

    def marked(text):
        gone = {p for _, a, b, _ in secrets.spans(text) for p in range(a, b)}
        flat = "".join("\x01" if p in gone else c for p, c in enumerate(text))
        return re.sub("\x01+", "[secret]", flat)

    want = [(i, t and marked(t)) for i, t in texts(docs)]
    assert got.columns == COLUMNS and texts(got) == sorted(want, key=str)
    assert not any("hunter2" in (t or "") for _, t in texts(got))


def test_encode(spark, sf, docs, library):
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids)) for r in STAGES["encode"](spark, docs, sf).collect()), key=str)
    want = []
    for i, t in texts(docs):
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes()))
    assert got == sorted(want, key=str)


def test_run_applies_the_stages_one_after_the_other(spark, sf):
    now = queries.table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, sf), "test")
    got = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, bytes(r.ids)) for r in got.collect()) == sorted((r.doc_id, bytes(r.ids)) for r in now.collect())


def test_no_documents(spark, sf, docs):
    for name in STAGES:
        assert STAGES[name](spark, docs.limit(0), sf).count() == 0


def test_stages_keep_clashing_columns(spark, sf, docs):
    """Columns named like those that stages make for themselves pass through every stage but the last."""
    names = ["_copy", "copy", "row", "count", "kept", "rep", "root", "keep", "grade", "runs"]
    given = docs.where("doc_id >= 900 or doc_id is null").selectExpr("*", *(f"{k} as {n}" for k, n in enumerate(names)))
    for name in ("quality", "near_duplicates", "decontaminate", "secrets"):
        got = STAGES[name](spark, given, sf)
        assert got.columns == [*COLUMNS, *names]
        assert all(tuple(r)[5:] == tuple(range(len(names))) for r in got.collect())
    assert STAGES["encode"](spark, given, sf).count() == given.count()
