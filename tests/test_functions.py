import random
from datetime import date
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from vaultfeed.functions import codes
from vaultfeed.functions.measures import commission_amount, commission_problem, percent_of
from vaultfeed.functions.period import (
    accounting_range,
    months_between,
    period_date,
    text_in_range,
    with_period,
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("batch", "months", "start", "end"),
    [
        ("20230101", 3, date(2022, 10, 1), date(2022, 12, 31)),
        ("20240301", 4, date(2023, 11, 1), date(2024, 2, 29)),
        ("20230131", 1, date(2022, 12, 1), date(2022, 12, 31)),
        ("20230101", 12, date(2022, 1, 1), date(2022, 12, 31)),
    ],
)
def test_accounting_range(batch, months, start, end):
    assert accounting_range(batch, months) == (start, end)


@pytest.mark.parametrize(("batch", "months"), [("2023", 1), ("2023-1-1", 1), ("20230101", 0)])
def test_accounting_range_rejects(batch, months):
    with pytest.raises(ValueError):
        accounting_range(batch, months)


PERIODS = [
    ("2022_4", date(2022, 4, 1)),
    ("2022-04", date(2022, 4, 1)),
    ("202204", date(2022, 4, 1)),
    ("2022_12", date(2022, 12, 1)),
    ("2022-04-15", date(2022, 4, 15)),
    ("2022-04-15 00:00:00", date(2022, 4, 15)),
    ("2022-4-15", date(2022, 4, 1)),
    ("2022_13", None),
    ("2022-02-31", None),
    ("junk", None),
    ("not a period", None),
    ("", None),
    (None, None),
]


def test_period_date(spark):
    texts, days = zip(*PERIODS, strict=True)
    assert column(spark, texts, "string", period_date) == list(days)


def test_period_parts(spark):
    df = spark.createDataFrame([("2022_4",), ("2022-11-15",), ("x",)], "acctg_yr_mo_txt string")
    got = [tuple(r)[1:] for r in with_period(df).collect()]
    assert got == [
        (2022, "04", date(2022, 4, 1), date(2022, 4, 1)),
        (2022, "11", date(2022, 11, 1), date(2022, 11, 15)),
        (None, None, None, None),
    ]


def test_text_range_keeps_what_the_parsed_date_keeps(spark):
    start, end = date(2022, 3, 1), date(2022, 4, 30)
    texts = [t for t, _ in PERIODS]
    got = column(spark, texts, "string", lambda c: F.coalesce(text_in_range(c, start, end), F.lit(False)))
    assert got == [d is not None and start <= d <= end for _, d in PERIODS]


def test_months_between_looks_at_months_only_in_the_edge_years(spark):
    data = [(2020, 11), (2020, 12), (2021, None), (2021, 12), (2022, 1), (None, 5), (2020, None)]
    df = spark.createDataFrame(data, "y int, m int")
    y, m = F.col("y"), F.col("m")
    inside = months_between(y, m, (2020, 12), (2021, 12))
    assert [tuple(r) for r in df.filter(inside).collect()] == [(2020, 12), (2021, None), (2021, 12)]
    kept = months_between(y, m, (2020, 12), (2021, 11), keep_missing=True)
    assert [tuple(r) for r in df.filter(kept).collect()] == [(2020, 12), (None, 5)]


def test_int_text(spark):
    got = column(spark, ["007", "2021.0", " 12 ", "A12", "", None], "string", codes.int_text)
    assert got == ["7", "2021", "12", None, None, None]


def test_join_number(spark):
    got = column(spark, [" 0012 ", "A12", "", None], "string", codes.join_number)
    assert got == [12, None, None, None]


def test_normalise_code_pads_and_cuts(spark):
    got = column(spark, ["7", " 88 ", "1234", "", None], "string", codes.normalise_code)
    assert got == ["007", "088", "123", "000", None]


def test_reference_split(spark):
    refs = ["000000000000123004", "000000000000123", "00000000000012300x", None]
    roots = column(spark, refs, "string", codes.reference_root)
    assert roots == ["000000000000123"] * 3 + [None]
    assert column(spark, refs, "string", codes.reference_revision) == [4, None, None, None]


def test_list_flag(spark):
    values = ["CU", "ZZ", "", None]
    flag = lambda c: codes.list_flag(c, codes.POLICY_SYMBOLS)
    assert column(spark, values, "string", flag) == ["InList", "NotInList", "NotInList", ""]
    strict = lambda c: codes.list_flag(c, ["CU"], missing="NotInList")
    assert column(spark, values, "string", strict)[-1] == "NotInList"


def test_reinsurer_status(spark):
    got = column(spark, ["", "0060", "0099", None], "string", codes.reinsurer_status)
    assert got == ["", "", "NotInList", ""]


def test_list_sizes():
    assert [len(x) for x in (codes.POLICY_SYMBOLS, codes.MAJOR_PERILS, codes.SUBLINES)] == [8, 75, 44]


def test_commission_keeps_cents(spark):
    df = spark.createDataFrame(
        [(Decimal("1234567.89"), Decimal("12.50")), (Decimal("10.00"), None)],
        "p decimal(18,2), r decimal(18,2)",
    )
    percent = commission_amount(F.col("p"), F.col("r"))
    factor = commission_amount(F.col("p"), F.col("r"), per_hundred=False)
    assert [tuple(r) for r in df.select(percent, factor).collect()] == [
        (Decimal("154320.99"), Decimal("15432098.63")),
        (None, None),
    ]


def test_commission_rates_are_not_cut(spark):
    data = [("1000000.00", "0.123456"), ("100.00", "1234567.1234567"), ("0.01", "1000000"), ("9999999999999999.99", "9999999999999")]
    df = spark.createDataFrame([(Decimal(p), Decimal(r)) for p, r in data], "p decimal(18,2), r decimal(20,7)")
    factor = commission_amount(F.col("p"), F.col("r"), per_hundred=False)
    got = [tuple(r) for r in df.select(factor, commission_amount(F.col("p"), F.col("r"))).collect()]
    assert got == [
        (Decimal("123456.00"), Decimal("1234.56")),
        (Decimal("123456712.35"), Decimal("1234567.12")),
        (Decimal("10000.00"), Decimal("100.00")),
        (None, None),
    ]


def test_commission_is_exact(spark):
    """Against exact fractions: random amounts and rates of any length, both signs, and the cases next to half a cent."""
    dice = random.Random(11)
    data = [("0.10", "4.9999996"), ("1000000000.00", "0.12345678"), ("0.01", "50"), ("-0.01", "50"), ("0.01", "49.999999999999999999"), ("100.00", "0.005"), ("9999999999999999.99", "100")]
    for _ in range(300):
        premium = dice.randrange(10 ** dice.randint(1, 18)) * dice.choice((1, -1))
        places = dice.randint(0, 18)
        digits = dice.randint(1, 20 + places)
        data.append((f"{Decimal(premium).scaleb(-2):f}", f"{Decimal(dice.randrange(10**digits) * dice.choice((1, -1))).scaleb(-places):f}"))
    df = spark.createDataFrame(data, "p string, r string").withColumns({"p": F.col("p").cast("decimal(18,2)"), "r": F.col("r").cast("decimal(38,18)")})
    columns = [commission_amount(F.col("p"), F.col("r"), h) for h in (True, False)] + [commission_problem(F.col("p"), F.col("r"), h) for h in (True, False)]
    for (p, r), row in zip(data, df.select(*columns).collect(), strict=True):
        for k, per in enumerate((100, 1)):
            cents = Fraction(p) * 100 * Fraction(r) / per
            want = (abs(cents) + Fraction(1, 2)).__floor__() * (1 if cents >= 0 else -1)
            fits = abs(want) < 10**18
            assert row[k] == (Decimal(want).scaleb(-2) if fits else None), (p, r, per)
            assert row[2 + k] == (None if fits else "amount beyond money")


def test_commission_problems(spark):
    df = spark.createDataFrame([("1", "2"), (None, "2"), ("x", "2"), ("1", "x"), ("1" * 17, "1"), ("1", "9" * 21)], "p string, r string")
    got = [r[0] for r in df.select(commission_problem(F.col("p"), F.col("r"))).collect()]
    assert got == [None, None, "premium is no amount", "rate is no number of 20 digits", "premium is no amount", "rate is no number of 20 digits"]


def test_percent_of_the_smallest_premium(spark):
    df = spark.createDataFrame([(Decimal("100.00"), Decimal("0.01"))], "n decimal(18,2), d decimal(18,2)")
    percent = percent_of(F.col("n"), F.col("d"))
    assert df.select(percent, commission_amount(F.col("d"), percent)).first() == (Decimal("1000000.00"), Decimal("100.00"))


def test_percent_of(spark):
    data = [("1.00", "3.00"), ("1.00", "0.00"), (None, "5.00"), ("5.00", None)]
    df = spark.createDataFrame(
        [tuple(None if v is None else Decimal(v) for v in r) for r in data],
        "n decimal(28,2), d decimal(28,2)",
    )
    got = [r[0] for r in df.select(percent_of(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("33.33"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00")]


def test_employment_liability(spark):
    data = [
        ("02", "GL", "GL", "560 ", "E"),
        ("01", "GL", "GL", "560", ""),
        ("02", "BOP", "BC", "662", "E"),
        ("02", "BOP", "GL", "662", ""),
        (None, None, None, "172", "E"),
        (None, "GL", "GL", None, ""),
    ]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, e string")
    got = df.select(codes.employment_liability(*map(F.col, "abcd")), "e").collect()
    assert all(r[0] == r[1] for r in got)
