import hashlib
import random
import zlib

import pytest

from vaultfeed.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [None if v is None else str(v) for v in (*row[:3], None if row[3] is None else row[3] + more, row[4])]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(level, at):
    """The top over the nodes of a level, and (side, sibling) of each step from one of them."""
    way = []
    while len(level) > 1:
        way.append(("left", level[at - 1]) if at % 2 else ("right", level[at + 1]) if at + 1 < len(level) else ("none", ""))
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
        at //= 2
    return level[0], way


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for members in groups.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subroots = [climb([leaf(r) for r in groups[x]], 0)[0] for x in names]
    out = []
    for k, name in enumerate(names):
        root, upper = climb(subroots, k)
        hashes = [leaf(r) for r in groups[name]]
        for at, row in enumerate(groups[name]):
            way = climb(hashes, at)[1] + upper
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            now = leaf(row, 1) if tampered else hashes[at]
            for side, other in way:
                now = h(other, now) if side == "left" else h(now, other)
            out.append((row[0], hashes[at], subroots[k], root, h(*(s for _, s in way)), now, now == root))
    return sorted(out, key=str)


def result(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.select(*names).collect()), key=str)


def sample(n, langs, seed=1):
    dice = random.Random(seed)
    return [(i, dice.choice(["web", None, "é"]), dice.choice(langs), dice.choice([None, i, 10**6]), dice.choice(["", None, f"text {i}"])) for i in range(n)]


def test_query_equals_brute_force(spark, sf, con):
    rows = con.sql("select doc_id, source, lang, n_chars, text from documents").fetchall()
    got = result(queries.op12_merkle(spark, sf))
    assert got == brute(rows) and {r[-1] for r in got} == {True, False}


def test_sql_equals_brute_force(con):
    rows = con.sql("select doc_id, source, lang, n_chars, text from documents").fetchall()
    assert sorted(con.sql(merkle.SQL).fetchall(), key=str) == brute(rows)


@pytest.mark.parametrize(("levels", "n"), [(2, 65), (3, 513), (8, 700)])
def test_storeys_of_any_height(spark, monkeypatch, levels, n):
    """Blocks of 2 to 256 leaves, odd runs, trees of one leaf and more trees than a block holds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    langs = {65: [None, "", "en", "zz", "Ä", "single"], 513: [f"l{k}" for k in range(40)], 700: [None]}[n]
    rows = [*sample(n, langs), (10**9, "s", "lone", 5, "x")]
    assert result(merkle.digests(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, None, None, None, None), (None, "s", "en", 3, "abc"), (7, "", "", 0, ""), (8, "s", "en", (1 << 63) - 1, "👍\x00" * 9), (9, "s", "en", 1, "long " * 50_000)]
    rows += [rows[2]] * 300 + [(7, "other", "", 0, "")] + [(i, "s", "en", 1, "t") for i in range(14, 40)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tree", "2 as pos", "3 as hash", "4 as block", "5 as start", "6 as floor", "7 as n")
    assert result(merkle.digests(df)) == brute(rows)


def test_empty_and_single(spark):
    assert result(merkle.digests(spark.createDataFrame([], SCHEMA))) == []
    one = [(5, "s", "en", 1, "t")]
    got = result(merkle.digests(spark.createDataFrame(one, SCHEMA)))
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3]
