"""Money. Amounts stay decimal; nothing passes through binary floating point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


#: Digits of a rate: 20 before the point, 18 after it.
RATE = "decimal(38,18)"
#: An amount over the smallest one is a percentage of up to 20 digits.
PERCENT = "decimal(22,2)"


def commission_amount(premium: Column, rate: Column, per_hundred: bool = True) -> Column:
    """Premium times commission rate to the cent, rounded half up once; ``per_hundred`` if the rate is a percentage.

    The product of 18 and 38 digits does not fit a decimal, so the whole and the fractional part of the rate are
    multiplied apart, in cents, and what is left below a cent is only looked at to round. An amount that no money column
    can hold is null and does not end the job; ``commission_problem`` says so.
    """
    amount, exact = premium.try_cast(MONEY), rate.try_cast(RATE)
    one, cent = F.lit(1).cast("decimal(1,0)"), F.lit("0.01").cast("decimal(2,2)")
    cents = (F.abs(amount) * F.lit(100).cast("decimal(3,0)")).cast("decimal(18,0)")
    size = F.abs(exact)
    below = cents * (size % one).cast("decimal(18,18)")
    whole = F.try_add(F.try_multiply(cents, F.floor(size)), F.floor(below)).try_cast("decimal(26,0)")
    rest = (below % one).cast("decimal(18,18)")
    if per_hundred:
        hundredths = whole % F.lit(100).cast("decimal(3,0)")
        up = hundredths + rest >= F.lit(50)
        whole = ((whole - hundredths) * cent).cast("decimal(26,0)")
    else:
        up = rest >= F.lit("0.5").cast("decimal(2,1)")
    rounded = ((whole + up.cast("int").cast("decimal(1,0)")).cast("decimal(26,0)") * cent).try_cast(MONEY)
    return F.when((amount < 0) != (exact < 0), (-rounded).cast(MONEY)).otherwise(rounded)


def commission_problem(premium: Column, rate: Column, per_hundred: bool = True) -> Column:
    """Why a commission has no amount although premium and rate are there; null where nothing is wrong."""
    given = premium.isNotNull() & rate.isNotNull()
    return (
        F.when(given & premium.try_cast(MONEY).isNull(), "premium is no amount")
        .when(given & rate.try_cast(RATE).isNull(), "rate is no number of 20 digits")
        .when(given & commission_amount(premium, rate, per_hundred).isNull(), "amount beyond money")
    )


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two places; 0 where either is missing or whole is 0."""
    share = F.try_divide(part.cast(MONEY), whole.cast(MONEY))
    percent = F.try_multiply(share, F.lit(100)).try_cast(PERCENT)
    return F.coalesce(percent, F.lit(0).cast(PERCENT))
