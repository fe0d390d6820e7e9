"""Accounting periods: the months before a batch date, and period text in mixed layouts."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accounting_range(batch_date: str, months: int) -> tuple[date, date]:
    """First and last day of the ``months`` whole months before a ``YYYYMMDD`` batch date."""
    if len(batch_date) != 8 or not batch_date.isdigit():
        raise ValueError(f"batch date must be YYYYMMDD, got {batch_date!r}")
    if months < 1:
        raise ValueError(f"number of months must be positive, got {months}")
    first_of_batch = datetime.strptime(batch_date, "%Y%m%d").date().replace(day=1)
    year, month = divmod(first_of_batch.year * 12 + first_of_batch.month - 1 - months, 12)
    return date(year, month + 1, 1), first_of_batch - timedelta(days=1)


# Year, any separators, one or two month digits: the first seven characters of period text.
_YEAR_MONTH = r"^(\d{4})[-_]*(\d{1,2})[-_]*$"
_FULL_DATE = r"^\d{4}-\d{2}-\d{2}"


def period_year(text: Column) -> Column:
    return F.left(text, F.lit(4)).try_cast("int")


def period_month(text: Column) -> Column:
    """Two-digit month text."""
    digits = F.regexp_extract(F.left(text, F.lit(7)), _YEAR_MONTH, 2)
    return F.when(digits != "", F.lpad(digits, 2, "0"))


def period_first_day(text: Column) -> Column:
    """First day of the month, or null where the text names no month."""
    year = F.regexp_extract(F.left(text, F.lit(7)), _YEAR_MONTH, 1)
    return F.try_to_date(F.concat_ws("-", year, period_month(text), F.lit("01")), "yyyy-MM-dd")


def period_date(text: Column) -> Column:
    """The day itself where the text holds a whole date, else the first of its month."""
    day = F.when(text.rlike(_FULL_DATE), F.left(text, F.lit(10)))
    return F.when(F.length(text) >= 10, F.try_to_date(day, "yyyy-MM-dd")).otherwise(
        period_first_day(text)
    )


def with_period(df: DataFrame, text_column: str = "acctg_yr_mo_txt") -> DataFrame:
    """Add the parsed year, month, first day of the month and period date."""
    text = F.col(text_column)
    return df.withColumns(
        {
            "acctg_yr": period_year(text),
            "acctg_mo": period_month(text),
            "acctg_mo_first_day": period_first_day(text),
            "acctg_dt": period_date(text),
        }
    )


def text_in_range(text: Column, start: date, end: date) -> Column:
    """Period text that falls between two days.

    All layouts begin with the year, so the comparison of the raw text keeps every match and
    lets the file scan skip row groups of other years.
    """
    years = (text >= str(start.year)) & (text < str(end.year + 1))
    return years & period_date(text).between(F.lit(start), F.lit(end))


def months_between(
    year: Column,
    month: Column,
    start: tuple[int, int],
    end: tuple[int, int],
    keep_missing: bool = False,
) -> Column:
    """Separate year and month columns inside an inclusive run of months.

    A month is looked at only where the run starts or ends inside its year, so a row of a whole
    year counts even if its month is missing. ``keep_missing`` also keeps rows without a year.

    Years are a list: Spark moves comparisons into a year that is itself a CASE, and then builds no filter for the
    other side of a join from them (see ``prune_before_shuffles``); a list it leaves whole.
    """
    y, m = year.try_cast("int"), month.try_cast("int")
    (first_year, first_month), (last_year, last_month) = start, end
    inside = y.isin(*range(first_year, last_year + 1))
    if first_month > 1:
        inside = inside & ((y > first_year) | (m >= first_month))
    if last_month < 12:
        inside = inside & ((y < last_year) | (m <= last_month))
    return y.isNull() | inside if keep_missing else inside
