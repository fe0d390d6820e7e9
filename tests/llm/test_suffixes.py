import random

import numpy as np
import pytest

from vaultfeed.llm import queries, suffixes
from vaultfeed.llm.common import RunHash

from .conftest import ID_TEXT, sha


def brute(docs):
    """Every 100-byte string in order of document and place; later ones are removed."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 99):
            s = raw[p : p + 100]
            gone[p : p + 100] |= s in seen
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        opens = int((gone[1:] > gone[:-1]).sum()) + int(gone[0])
        out[i] = (len(raw), int(gone.sum()), opens, sha(kept))
    return out


def result(df):
    return {r.doc_id: tuple(r)[1:] for r in suffixes.digests(df).collect()}


def test_blind_tries_and_deep_shallow_order():
    dice = random.Random(5)
    for _ in range(200):
        rows = [bytes(dice.choices(b"\x00ab\xff", k=16)) for _ in range(dice.randint(1, 30))]
        rows += dice.choices(rows, k=5)
        assert [rows[i] for i in suffixes.blind_order(rows)] == sorted(rows)
        wide = [dice.choice((b"x" * 48, b"y" * 48)) + r for r in rows]
        order, common = suffixes.deep_shallow(np.array([list(r) for r in wide], np.uint8))
        assert [wide[i] for i in order] == sorted(wide)
        for a, b, n in zip(order, order[1:], common, strict=False):
            assert wide[a][:n] == wide[b][:n] and (n == 64 or wide[a][n] != wide[b][n])


def test_anchor_depends_on_the_window_alone(monkeypatch):
    monkeypatch.setattr(suffixes, "_BLOCK", 64)
    dice = random.Random(1)
    passage = bytes(dice.choices(b"abcd", k=300))
    one, two = b"q" * 77 + passage + b"r" * 50, b"zz" + passage
    at = [suffixes.anchors(RunHash(np.frombuffer(x, np.uint8)), len(x)) for x in (one, two)]
    assert (at[0][77 : 77 + 201] - 77 == at[1][2 : 2 + 201] - 2).all()


@pytest.mark.parametrize("chunk", [400, 4 << 20])
def test_planted_repeats(spark, monkeypatch, chunk):
    dice = random.Random(chunk)
    passages = ["".join(dice.choices("abcdef é", k=n)) for n in (60, 99, 100, 101, 180, 400)]
    docs = [(0, "".join(passages))]
    for i in range(1, 40):
        parts = [p if dice.random() < 0.7 else p[: len(p) // 2] + "#" + p[len(p) // 2 :] for p in dice.choices(passages, k=3)]
        docs.append((i, "".join(x + "".join(dice.choices("xyz", k=dice.randint(0, 9))) for x in parts)))
    docs += [(50, "z" * 350), (51, "z" * 120), (52, "z" * 100), (53, "z" * 99), (54, docs[0][1]), (-3, docs[7][1]), (60, None), (61, "")]
    slices = suffixes.slices
    monkeypatch.setattr(suffixes, "slices", lambda b, c, limit=chunk: slices(b, c, chunk))
    dice.shuffle(docs)
    assert result(spark.createDataFrame(docs, ID_TEXT).repartition(3)) == brute(docs)


def lined(n, line):
    """Documents with one line of under 100 bytes between different surroundings, some repeated."""
    dice = random.Random(n)
    around = ["".join(dice.choices("abcdefgh", k=60)) for _ in range(n)]
    docs = [(i, around[i] + line + around[-1 - i // 2]) for i in range(n)]
    return docs + [(n + i, t[:90] + line + t) for i, t in docs[:9]] + [(3, docs[3][1]), (n + 20, docs[5][1] + "é")]


LINE = "this line of boilerplate stands in a third of all documents, in its own surroundings"


def test_hot_anchors_are_split(spark, monkeypatch):
    docs = lined(60, LINE)
    frame = spark.createDataFrame(docs, ID_TEXT).repartition(3)
    rows = frame.selectExpr("doc_id", "text", "crc32(encode(text, 'UTF-8')) as check")
    hot, windows = suffixes.hot_anchors(rows, 20, 1)
    assert len(hot) and windows > 60 and not len(suffixes.hot_anchors(rows, 20_000, 1)[0])
    monkeypatch.setattr(suffixes, "HOT_SEGMENTS", 20)
    monkeypatch.setattr(suffixes, "SAMPLED", 1)
    monkeypatch.setattr(suffixes, "PACK_WINDOWS", 300)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4000)
    assert result(frame) == brute(list(dict.fromkeys(docs)))


def test_no_bucket_meets_all_windows_of_a_hot_anchor():
    raw = [t.encode() for _, t in lined(60, LINE)]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    hashed = RunHash(data)
    s = suffixes.segments(np.arange(len(raw)), np.zeros(len(raw), np.int64), data, offsets, hashed)
    _, anchor = s.keys(hashed)
    value, count = np.unique(anchor, return_counts=True)
    hot = s.take(np.flatnonzero(anchor == value[count.argmax()])).packed()
    sent = suffixes._scattered([hot], 16).to_pylist()
    sizes = [len(r["starts"]) // 4 for r in sent if r["windows"] is None]
    assert len(hot) >= 60 and len(sizes) == 16 and max(sizes) < sum(sizes) / 8


@pytest.mark.parametrize("limit", [1, 2, 8])
def test_hot_and_other_anchors_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(suffixes, "HOT_SEGMENTS", limit)
    monkeypatch.setattr(suffixes, "SAMPLED", 1)
    dice = random.Random(limit)
    passages = ["".join(dice.choices("abcdef é", k=n)) for n in (60, 99, 130, 250)]
    docs = [(i, "".join(p + "".join(dice.choices("xyz", k=9)) for p in dice.choices(passages, k=3))) for i in range(40)]
    docs += [(50, "z" * 350), (51, "z" * 120), (-3, docs[7][1])]
    assert result(spark.createDataFrame(docs, ID_TEXT).repartition(3)) == brute(docs)


def test_awkward_rows(awkward):
    got = sorted(map(tuple, suffixes.digests(awkward).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    alone = brute([r for r in {r for r in rows} if r[0] is not None])
    want = [(i, *(alone[i] if i is not None else (len(t.encode()), 0, 0, sha(t)))) for i, t in rows]
    assert got == sorted(want, key=str)


def test_one_id_with_two_texts(spark):
    got = suffixes.digests(spark.createDataFrame([(1, "ab" * 80), (1, "ab" * 80 + "c")], ID_TEXT)).collect()
    assert sorted(r.n_bytes for r in got) == [160, 161] and all(r.n_removed > 0 for r in got)


def test_empty_and_clashing(empty, clashing):
    assert suffixes.digests(empty).count() == 0
    assert {r.n_removed for r in suffixes.digests(clashing).collect()} == {0}


def test_query(spark, sf, documents):
    assert {r.doc_id: tuple(r)[1:] for r in queries.op3_repeated_bytes(spark, sf).collect()} == brute(documents)
