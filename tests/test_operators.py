from datetime import datetime, timedelta
from functools import reduce
from random import Random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vaultfeed.operators import joins, newest, shape, widen
from vaultfeed.operators.quality import reconcile, run_audit

KEYS = [(1, None), (2, ""), (3, "A"), (4, "B")]
RIGHT = [("n", None), ("e", ""), ("a", "A")]


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame(KEYS, "i int, k string")
    return left, spark.createDataFrame(RIGHT, "v string, k string")


def test_three_null_policies(sides):
    left, right = sides
    on = joins.same("k")
    assert rows(joins.spread_join(left, right, on)) == [
        (1, None, None), (2, "", "e"), (3, "A", "a"), (4, "B", None),
    ]
    assert rows(joins.null_safe_join(left, right, on)) == [
        (1, None, "n"), (2, "", "e"), (3, "A", "a"), (4, "B", None),
    ]
    assert rows(joins.blank_join(left, right, on)) == [
        (1, "", "e"), (1, "", "n"), (2, "", "e"), (2, "", "n"), (3, "A", "a"), (4, "B", None),
    ]


def test_null_safe_equals_blank_without_blanks(sides):
    left, right = (df.filter("k is null or k <> ''") for df in sides)
    safe = joins.null_safe_join(left, right, joins.same("k")).select("i", "v")
    assert rows(safe) == rows(joins.blank_join(left, right, joins.same("k")).select("i", "v"))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, a third have none."""
    random = Random(7)
    data = [
        (i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{random.randrange(40)}")
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "i int, k string")


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_spreading_hot_keys_changes_nothing(spark, skewed, how, null_safe):
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), ("k1", 4), ("none", 5)], "k string, v int"
    )
    hot = joins.hot_keys(skewed, {"k": ["k"]}, rows_per_task=300)["k"]
    assert sorted(hot.values()) == [4, 4]
    on = joins.same("k")
    spread = joins.spread_join(skewed, right, on, how, null_safe, hot, ["i"])
    assert rows(spread) == rows(joins.spread_join(skewed, right, on, how, null_safe))


def test_what_is_hot_does_not_depend_on_the_table(spark, skewed):
    alone = joins.hot_keys(skewed.where("k = 'hot'"), {"k": ["k"]}, 300)["k"]
    rest = spark.range(50_000).selectExpr("id as i", "'n' || id as k")
    beside = joins.hot_keys(skewed.select("i", "k").union(rest), {"k": ["k"]}, 300)["k"]
    assert len(alone) == 1 and alone.items() <= beside.items()


@pytest.mark.parametrize("null_safe", [False, True])
def test_restricting_with_hot_keys_changes_nothing(spark, skewed, null_safe):
    keys = spark.createDataFrame([("hot",), (None,), ("k1",), ("none",)], "q string")
    hot = joins.hot_keys(skewed, {"k": ["k"]}, 300)["k"]
    plain = joins.restrict_to(skewed, keys, [("k", "q")], null_safe)
    assert rows(joins.restrict_to(skewed, keys, [("k", "q")], null_safe, hot, ["i"])) == rows(plain)


def test_a_key_that_is_hot_by_one_of_its_columns(spark, skewed):
    right = spark.createDataFrame([("hot", 3, "a"), ("hot", 6, "b"), ("k1", 7, "c")], "k string, i long, v string")
    hot = joins.hot_keys(skewed, {"k": ["k"]}, 300)["k"]
    on = joins.same("k", "i")
    assert rows(joins.spread_join(skewed, right, on, hot=hot, hot_on=["k"])) == rows(joins.spread_join(skewed, right, on))


@pytest.mark.parametrize("buckets", [1, 7, 1 << 18])
def test_hot_keys_are_counted_exactly(spark, buckets):
    """Keys just at and above the limit, among 100 times as many rows of others that share their buckets."""
    rest = spark.range(200_000).selectExpr("id % 40000 as k", "cast(id % 3 as string) as s")
    named = [spark.range(n).selectExpr(f"{k} as k", f"'{k}' as s") for k, n in ((-1, 900), (-2, 901), (-3, 2000))]
    df = reduce(lambda a, b: a.union(b), [rest, *named])
    got = joins.hot_keys(df, {"k": ["k"], "s": ["s"], "both": ["k", "s"]}, 900, buckets)
    assert sorted(got["k"].values()) == sorted(got["both"].values()) == [2, 3]
    assert sorted(got["s"].values()) == [2, 3, 75, 75, 75]
    key = {r[0]: r[1] for r in df.filter("k < 0").select("k", F.xxhash64("k")).distinct().collect()}
    assert got["k"] == {key[-2]: 2, key[-3]: 3}
    nulls = joins.hot_keys(spark.range(50).selectExpr("nullif(id, id) as k"), {"k": ["k"]}, 10, buckets)
    assert list(nulls["k"].values()) == [5]


def test_hot_keys_need_a_large_table(skewed):
    assert joins.hot_keys(skewed, {"k": ["k"], "both": ["k", "i"]}) == {"k": {}, "both": {}}


def test_lookup_join_broadcasts_only_a_counted_list(spark, skewed):
    codes = spark.createDataFrame([("hot", "x"), ("k1", "y")], "c string, d string")
    small = joins.lookup_join(skewed, codes, [("k", "c")])
    large = joins.lookup_join(skewed, codes, [("k", "c")], broadcast_rows=1)
    assert rows(small) == rows(large)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (small, large)]
    assert ["strategy=broadcast" in p for p in plans] == [True, False]


def test_restrict_to_does_not_multiply(spark, sides):
    left, _ = sides
    twice = spark.createDataFrame([("A",), ("A",), (None,)], "k string")
    assert rows(joins.restrict_to(left, twice, joins.same("k"))) == [(3, "A")]
    assert len(rows(joins.restrict_to(left, twice, joins.same("k"), null_safe=True))) == 2


def test_latest_per_key(spark):
    data = [
        ("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "x"), ("b", 1, "w"),
        (None, 1, "p"), (None, 3, "q"), ("c", None, "only"),
    ]
    df = spark.createDataFrame(data, "k string, d int, v string")
    expected = [("a", 2, "z"), ("b", 1, "w"), ("c", None, "only"), (None, 3, "q")]
    for frame in (df, df.orderBy(F.col("v").desc())):
        got = newest.latest_per_key(frame, ["k"], newest.newest_first("d", "v"))
        assert rows(got) == sorted(expected, key=str)


def test_rank_is_cut_before_the_shuffle(spark):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("k"))
    plan = newest.latest_per_key(df, ["k"], [F.col("id").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_filter_before_and_after_the_window(spark):
    df = spark.createDataFrame(
        [("a", 1, "45"), ("a", 2, "99"), ("b", 1, "45")], "k string, d int, s string"
    )
    order, own = newest.newest_first("d"), F.col("s") == "45"
    assert rows(newest.latest_then_filter(df, ["k"], order, own)) == [("b", 1, "45")]
    assert rows(newest.latest_per_key(df.filter(own), ["k"], order)) == [
        ("a", 1, "45"), ("b", 1, "45"),
    ]


def test_first_value_respects_nulls_and_codes(spark):
    df = spark.createDataFrame(
        [("a", 1, "old", "x"), ("a", 2, None, "y"), ("b", 1, "n", "x"), ("b", 1, "m", "x")],
        "k string, d int, v string, c string",
    )
    assert rows(newest.first_value_per_key(df, ["k"], ["d"], "v", "first")) == [
        ("a", None), ("b", "n"),
    ]
    beside = newest.first_value_per_key(df, ["k"], ["d"], "v", "first", ["c"])
    assert rows(beside) == [("a", "x", None), ("a", "y", None), ("b", "x", "n")]


@pytest.mark.parametrize("unit", ["minute", "hour", "day", "year"])
@pytest.mark.parametrize("most", [1_000_000, 40, 16])
def test_previous_value_over_slices(spark, unit, most):
    random = Random(3)
    start = datetime(2024, 1, 1)
    data = [
        (i, random.choice("aab"), start + timedelta(minutes=random.randrange(4000)),
         random.choice([None, 1.0, 2.5, 7.0]))
        for i in range(400)
    ] + [(400, "a", None, 3.0), (401, None, start, 4.0)]
    df = spark.createDataFrame(data, "i int, k string, t timestamp, v double")
    got = newest.previous_value(df, ["k"], "t", ["i"], "v", "p", unit, most).select("i", "p")
    expected = []
    for key in {r[1] for r in data}:
        group = sorted(
            (r for r in data if r[1] == key),
            key=lambda r: (r[2] is not None, r[2] or start, r[0]),
        )
        older = [None, *(r[3] for r in group)]
        expected += [(r[0], p) for r, p in zip(group, older, strict=False)]
    assert rows(got) == sorted(expected, key=str)


def test_previous_value_cuts_a_slice_of_one_time(spark):
    moment = F.lit("2024-01-01").cast("timestamp")
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").alias("k"), moment.alias("t"), F.col("id").alias("i")
    )
    cuts = newest._cuts(df, ["k", "t"], F.struct("t", "i"), 1_000).collect()
    assert {r["k"] for r in cuts} == {"hot", None}
    places = {r["k"]: [c["i"] for c in r["_cuts"]] for r in cuts}
    assert 8 <= len(places["hot"]) <= 18 and places["hot"] == sorted(places["hot"])
    ends = [-1, *places["hot"], 20_000]
    assert max(b - a for a, b in zip(ends, ends[1:], strict=False)) * 2 / 3 < 2_500
    got = newest.previous_value(df, ["k"], "t", ["i"], "i", "p", "hour", 1_000)
    expected = [(r, None if r < 2 and r != 1 else r - 3 if r % 3 == 0 else r - (1 if r % 3 == 2 else 2)) for r in range(20_000)]
    expected[1] = (1, None)
    assert sorted(tuple(r) for r in got.select("i", "p").collect()) == expected


def test_previous_value_without_rows(spark):
    df = spark.createDataFrame([], "k string, t timestamp, i int, v double")
    got = newest.previous_value(df, ["k"], "t", ["i"], "v", "p")
    assert got.columns == ["k", "t", "i", "v", "p"] and got.collect() == []


def test_repeated_keys(skewed):
    for hot in ({}, None, joins.hot_keys(skewed, {"k": ["k"]}, 300)["k"]):
        got = newest.repeated_keys(skewed, ["k"], row_id=["i"], hot=hot)
        counts = {r["k"]: r["cnt"] for r in got.collect()}
        assert got.count() == sum(counts.values()) == 3000
        assert counts["hot"] == counts[None] == 1000


ATTRIBUTES = [
    ("p1", "Per Event", 1, 5.0), ("p1", "Per Event", 2, None), ("p1", "Per Event", 0, 9.0),
    ("p1", None, 1, 7.0), ("p2", "Total", 1, None), ("p3", "Total", 1, 1.0),
    ("p3", "Total", 1, 2.0),
]


@pytest.mark.parametrize("few", [0, 48])
def test_widen(spark, monkeypatch, few):
    monkeypatch.setattr(widen, "_FEW_CELLS", few)
    df = spark.createDataFrame(ATTRIBUTES, "k string, t string, d int, v double")
    wide = widen.widen(df, ["k"], "t", {"Limit": "v", "Batch": "d"}, newest=["d"])
    assert wide.columns == [
        "k", "Limit - NA", "Limit - Per Event", "Limit - Total",
        "Batch - NA", "Batch - Per Event", "Batch - Total",
    ]
    assert rows(wide) == [
        ("p1", 7.0, 5.0, None, 1, 2, None), ("p2", None, None, None, None, None, 1),
        ("p3", None, None, 2.0, None, None, 1),
    ]
    assert widen.columns_with_prefix(wide, "Limit") == wide.columns[1:4]


def test_too_many_types_is_an_error(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("t"))
    with pytest.raises(ValueError, match="more than 4"):
        widen.distinct_types(df, "t", at_most=4)


def test_file_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Commission Amount (Calculated)` int, `A - B` int")
    assert shape.with_file_names(df).columns == ["CommissionAmount_Calculated_", "A_B"]
    clash = spark.createDataFrame([(1, 2)], "`A - B` int, `A_B` int")
    with pytest.raises(ValueError, match="A_B"):
        shape.with_file_names(clash)


def test_union_by_name_ignores_order_and_pads(spark):
    a = spark.createDataFrame([(1, "x")], "n int, code string")
    b = spark.createDataFrame([("y", 2, "e")], "code string, n int, extra string")
    assert rows(shape.union_by_name([a, b])) == [(1, "x", None), (2, "y", "e")]
    assert shape.pad_to_schema(a, ["code", "more"]).columns == ["code", "more", "n"]


def test_reconcile_and_audit(spark):
    df = spark.createDataFrame([("s", 1.5, "2024"), ("s", 2.0, "2025")], "s string, a double, d string")
    assert rows(reconcile({"all": df, "none": df.filter("false")})) == [("all", 2), ("none", 0)]
    audit = run_audit(df, ["s"], "a", "d", "20250101").first()
    assert (audit["row_count"], float(audit["total_amount"]), audit["newest_date"]) == (2, 3.5, "2025")
