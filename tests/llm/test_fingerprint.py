import random

import numpy as np

from vaultfeed.llm import fingerprint, queries

from .conftest import ID_TEXT, sha


def plain_sketch(text):
    """The same fingerprint, k-mer by k-mer."""
    points = [np.uint64(ord(c)) for c in text]
    if not points:
        return [0] * fingerprint.TUPLES
    with np.errstate(over="ignore"):
        codes = [fingerprint.mix(p + fingerprint._STEP) for p in points]
        width = min(fingerprint.K, len(codes))
        seen, rows = {}, []
        for i in range(len(codes) - width + 1):
            gram = codes[i]
            for c in codes[i + 1 : i + width]:
                gram = gram * fingerprint._STEP + c
            gram = fingerprint.mix(gram)
            seen[gram] = seen.get(gram, -1) + 1
            rows.append((fingerprint.mix(gram + np.uint64(seen[gram]) * fingerprint._STEP), i, gram))
        out = []
        for odd in fingerprint._ODD:
            least = sorted(rows, key=lambda r: r[0] * odd)[: fingerprint.TUPLE]
            value = np.uint64(0)
            for _, _, gram in sorted(least, key=lambda r: r[1]):
                value = fingerprint.mix(value + gram)
            out.append(int(value >> np.uint64(48)))
    return out


def brute(docs):
    docs = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode()))
    out = []
    for (i, t), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        n = len(t) // 4
        edited = t[: len(t) - n] + following[:n]
        marks = [fingerprint.sketch(x) for x in (t, edited, following)]
        like = [float(np.mean(marks[0] == m)) for m in marks[1:]]
        out.append((i, len(t), sha(edited), marks[0].tobytes().hex(), marks[1].tobytes().hex(), *like))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, fingerprint.fingerprints(df).collect()), key=str)


def test_sketch_equals_the_plain_definition():
    dice = random.Random(2)
    for text in ("", "a", "abcde", "abcdef", "aaaaaaaaaaaa", "é👍 x\x00y" * 9, "".join(dice.choices("abc ", k=400))):
        assert fingerprint.sketch(text).tolist() == plain_sketch(text)


def test_long_texts_are_sketched_in_steps():
    text = "".join(random.Random(3).choices("abcdefgh ", k=120_000))
    assert fingerprint.sketch(text).tolist() == plain_sketch(text)


def test_order_and_edits_show():
    dice = random.Random(4)
    words = ["".join(dice.choices("abcdefghij", k=6)) for _ in range(300)]
    text = fingerprint.sketch(" ".join(words))
    swapped = fingerprint.sketch(" ".join(words[150:] + words[:150]))
    small = fingerprint.sketch(" ".join(words[:100] + ["changed"] + words[101:]))
    other = fingerprint.sketch(" ".join("".join(dice.choices("abcdefghij", k=6)) for _ in range(300)))
    assert fingerprint.likeness(text, small) > 0.8 > fingerprint.likeness(text, swapped) > fingerprint.likeness(text, other)


def test_many_ranges(spark, monkeypatch):
    dice = random.Random(6)
    docs = [(dice.randint(-50, 50) * 10**9, "".join(dice.choices("abc é", k=dice.randint(0, 60)))) for _ in range(120)]
    docs = list({d[0]: d for d in docs}.values()) + [(10**15, None)]
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", 200)
    monkeypatch.setattr(fingerprint, "TASK_BYTES", 900)
    assert result(spark.createDataFrame(docs, ID_TEXT).repartition(5)) == brute(docs)


def test_awkward_rows(spark, awkward, empty, clashing):
    assert result(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert result(empty) == [] and len(result(clashing)) == 5
    assert result(spark.createDataFrame([(1, "alone")], ID_TEXT)) == brute([(1, "alone")])


def test_query(spark, sf, documents):
    got = sorted(map(tuple, queries.op5_fingerprint(spark, sf).collect()), key=str)
    assert got == brute(documents)
