import random
import re

import pytest

from vaultfeed.llm import decontaminate, queries

from .conftest import ID_TEXT, sha

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        ws, hit, found = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            n = min(window, len(iw))
            for k in range(len(iw) - n + 1) if n else ():
                for p in range(len(ws) - n + 1):
                    if ws[p : p + n] == iw[k : k + n]:
                        hit.update(range(p, p + n))
                        found.add(item)
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(ws), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return sorted(out, key=str)


def result(docs, items):
    return sorted(map(tuple, decontaminate.digests(docs, items).collect()), key=str)


def planted(seed):
    dice = random.Random(seed)
    vocabulary = ["a", "B", "c", "é", "d1"]
    items = [(k, " ".join(dice.choices(vocabulary, k=dice.choice((1, 3, 9, 10, 14, 30))))) for k in range(12)]
    items += [(3, "a second text of item three"), (None, "b c d1 a a a b b c c d1"), (20, None), (21, ""), (22, "?!")]
    docs = []
    for k in range(30):
        noise = " ".join(dice.choices(vocabulary + ["x", "y"], k=dice.randint(0, 60)))
        docs.append((k, f"{noise} {dice.choice(items)[1]}, {noise[:20]}"))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_planted_windows(spark, seed):
    docs, items = planted(seed)
    frames = spark.createDataFrame(docs, ID_TEXT), spark.createDataFrame(items, "item_id long, text string")
    assert result(*frames) == brute(docs, items)


def test_a_benchmark_in_blocks(spark, monkeypatch):
    docs, items = planted(7)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    frames = spark.createDataFrame(docs, ID_TEXT), spark.createDataFrame(items, "item_id long, text string")
    assert result(*frames) == brute(docs, items)


def test_spans_are_cut_and_covered_documents_go(spark):
    item = "one two three four five six seven eight nine ten eleven"
    filler = "these are all clean words of a longer text that stays in place as it is now"
    docs = [(1, f"{filler}. One two, three four five six seven eight nine TEN! {filler}"), (2, f"x {item} y"), (3, None), (4, filler)]
    frame = spark.createDataFrame(docs, ID_TEXT)
    got = {r.doc_id: r.text for r in decontaminate.clean(frame, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
    assert got == {1: f"{filler}. ! {filler}", 3: None, 4: filler}


def cleaned(spark, docs, items):
    frames = spark.createDataFrame(docs, ID_TEXT), spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, decontaminate.clean(*frames).collect()))


def test_blocks_do_not_change_what_is_cut(spark, monkeypatch):
    passage = [f"p{k}" for k in range(38)]
    items = [(k, " ".join(f"i{k}w{n}" for n in range(30))) for k in range(8)]
    items += [(20, " ".join(passage[:30])), (21, " ".join(passage[24:]))]
    noise = [f"n{k}" for k in range(60)]
    docs = [(10 * a + b, " ".join([*noise[:40], items[a][1], items[b][1]])) for a in range(8) for b in range(a)]
    docs += [(100, " ".join([*noise, *passage])), (101, None), (102, "")]
    whole = cleaned(spark, docs, items)
    assert whole == [(100, " ".join(noise) + " "), (101, None), (102, "")]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    assert cleaned(spark, docs, items) == whole


def test_awkward_rows(spark, awkward):
    items = [(1, "same words stand here twice and once more"), (2, "end")]
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert result(awkward, spark.createDataFrame(items, "item_id long, text string")) == brute(rows, items)


def test_empty_and_clashing(spark, empty, clashing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert result(empty, items) == [] and {r[2] for r in result(clashing, items)} == {0}


def test_query_equals_sql(spark, sf, con):
    got = queries.op7_decontaminate(spark, sf).toPandas()
    want = con.sql(decontaminate.SQL).df()
    assert sorted(got.columns) == sorted(want.columns)
    by = list(want.columns)
    assert got[by].sort_values("doc_id").values.tolist() == want.sort_values("doc_id").values.tolist()
