import random

import numpy as np
import pyarrow as pa
import pytest

from vaultfeed.llm import neardup, queries
from vaultfeed.llm.common import components

from .conftest import ID_TEXT


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute(docs, rule):
    sets = {i: shingles(t, rule.words) for i, t in docs}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and 100 * len(a & b) >= rule.percent * len(a | b):
                lo, hi = sorted((top(i), top(j)))
                root[hi] = lo
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def result(df, rule):
    return {r.doc_id: tuple(r)[1:] for r in neardup.clusters(df, rule).collect()}


def variants(seed, n, rate):
    dice = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    docs = []
    for _ in range(n // 12):
        base = dice.choices(words, k=dice.choice((8, 40, 150)))
        docs += [" ".join(dice.choice(words) if dice.random() < rate else w for w in base) for _ in range(12)]
    return list(enumerate(docs))


def test_shingles_of_a_batch():
    texts = ["One two THREE four", "a", "", None, "x y", "p q r p q r p", "end\n of\x0bit  all"]
    hashes, ends = neardup.shingle_sets(pa.array(texts), 3)
    assert np.diff(ends).tolist() == [len(shingles(t, 3)) for t in texts]
    again, cut = neardup.shingle_sets(pa.array(["one TWO three Four", "it of"]), 3)
    assert (again[: cut[1]] == hashes[: ends[1]]).all()


@pytest.mark.parametrize("rule", [neardup.Rule(3, 85), neardup.Rule()])
@pytest.mark.parametrize("rate", [0.005, 0.02])
def test_components_equal_brute_force(spark, rule, rate):
    docs = variants(rule.percent, 240, rate)
    assert result(spark.createDataFrame(docs, ID_TEXT), rule) == brute(docs, rule)


def test_large_groups_are_cut_into_cells(spark, monkeypatch):
    docs, rule = variants(3, 120, 0.01), neardup.Rule(3, 85)
    monkeypatch.setattr(neardup, "CELL_BYTES", 2000)
    assert result(spark.createDataFrame(docs, ID_TEXT), rule) == brute(docs, rule)


def test_awkward_rows(awkward):
    got = sorted(map(tuple, neardup.clusters(awkward).collect()), key=str)
    n = len(shingles("same words stand here twice and once more", 5))
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, n, 5, True), (6, n, 5, False), (6, n, 5, False)]
    want += [(None, n, None, True), (8, 1, 8, True), (9, 2, 9, True)]
    assert got == sorted(want, key=str)


def test_empty_and_clashing(empty, clashing):
    assert neardup.clusters(empty).count() == 0
    assert neardup.clusters(clashing, neardup.Rule(3, 85)).count() == 5


def test_chains_and_cycles_have_one_root(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 32), (32, 30), (40, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 31: 30, 32: 30}


def test_query(spark, sf, documents):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op9_near_duplicates(spark, sf).collect()}
    assert got == brute(documents, neardup.Rule(3, 85))


def just_linked(percent, n, dice):
    """Pairs of sets of 200 members or so whose similarity is the least that is linked."""
    out = []
    for _ in range(n):
        union = dice.randint(200, 260)
        both = -(-union * percent // 100)
        words = dice.sample(range(1 << 60), union)
        extra = (union - both) // 2
        out.append((words[: both + extra], words[:both] + words[both + extra :]))
    return out


@pytest.mark.parametrize("percent", [40, 50, 60, 85, 100])
def test_no_link_at_the_limit_is_lost(percent):
    """Pairs at the limit, 300 for each rule, and pairs below it: the matches follow the percentage."""
    rule, dice = neardup.Rule(3, percent), random.Random(percent)
    sets = [np.unique(neardup.mix(np.array(s, np.uint64))) for pair in just_linked(percent, 300, dice) for s in pair]
    ends = np.cumsum([0, *map(len, sets)])
    got = {tuple(sorted(p)) for p in neardup.linked_sets(np.concatenate(sets), ends, rule)}
    assert got == {(k, k + 1) for k in range(0, 600, 2)}
    side = np.arange(600) % 2
    assert {tuple(sorted(p)) for p in neardup.linked_sets(np.concatenate(sets), ends, rule, side)} == got
    assert neardup.linked_sets(np.concatenate(sets), ends, rule, side * 0) == []


@pytest.mark.parametrize("percent", [40, 60])
def test_components_of_low_similarity(spark, percent):
    docs, rule = variants(percent, 240, 0.08), neardup.Rule(3, percent)
    assert result(spark.createDataFrame(docs, ID_TEXT), rule) == brute(docs, rule)


def test_common_lines_make_no_group(spark):
    """Texts that share a line, a fifth of their words, have enough values of their own to drop out before any group."""
    dice = random.Random(1)
    line = " ".join(f"common{k}" for k in range(20))
    docs = [(i, line + " " + " ".join(f"w{dice.random()}" for _ in range(80))) for i in range(400)]
    rule = neardup.Rule(3, 85)
    every = neardup.written(neardup.described(spark.createDataFrame(docs, ID_TEXT), rule, "doc_id", "text"), "t")
    assert neardup.groups(every, rule).count() == 0


def test_a_group_of_copies_costs_its_length():
    """2,000 near copies: each list is walked once, not once for each of them."""
    dice = np.random.default_rng(2)
    base = dice.integers(1 << 62, size=400).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[1:], dice.integers(1 << 62, size=1).astype(np.uint64)])) for _ in range(2000)]
    ends = np.cumsum([0, *map(len, sets)])
    assert len(neardup.linked_sets(np.concatenate(sets), ends, neardup.Rule())) == 1999
