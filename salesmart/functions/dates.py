"""Calendar expressions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Calendar months as (year, month); (None, None) stands for rows without a day.
Months = frozenset[tuple[int | None, int | None]]


def order_period(date: Column) -> dict[str, Column]:
    """Year, month and quarter, under their CURATED names."""
    return {
        "ORDER_YEAR": F.year(date),
        "ORDER_MONTH": F.month(date),
        "ORDER_QUARTER": F.quarter(date),
    }


def day_of_week(date: Column) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return F.dayofweek(date) - F.lit(1)


def day_name(date: Column) -> Column:
    """Sun, Mon, ..."""
    return F.date_format(date, "EEE")


def week_part(date: Column) -> Column:
    """'Weekend' on Saturday and Sunday, else 'Weekday'."""
    return F.when(day_of_week(date).isin(0, 6), "Weekend").otherwise("Weekday")


def calendar_attributes(date: Column) -> dict[str, Column]:
    """The attributes of a calendar day, in the order of the date dimension."""
    return {
        "order_year": F.year(date),
        "order_month": F.month(date),
        "order_quarter": F.quarter(date),
        "order_dayofweek": day_of_week(date),
        "order_dayname": day_name(date),
        "order_dayofmonth": F.dayofmonth(date),
        "order_weekday": week_part(date),
    }


def days_between(first: Column, last: Column) -> Column:
    """Number of days from ``first`` to ``last``, both counted."""
    return F.datediff(last, first) + F.lit(1)


def months_of(rows: DataFrame, day: str = "ORDER_DT") -> Months:
    """The months that occur; a calendar has few, so the driver can hold them."""
    found = rows.select(F.year(day).alias("year"), F.month(day).alias("month")).distinct()
    return frozenset((r["year"], r["month"]) for r in found.collect())


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def in_months(months: Months, year: str, month: str) -> Column:
    """Whether a row's year and month columns name one of the months; prunes partitions by them."""
    by_year: dict[int | None, list[int]] = {}
    for y, m in sorted(months, key=str):
        by_year.setdefault(y, []).append(m)
    return _any(
        F.col(year).isNull() if y is None else (F.col(year) == y) & F.col(month).isin(months_)
        for y, months_ in by_year.items()
    )


def days_in(months: Months, day: str = "ORDER_DT") -> Column:
    """Whether a day lies in one of the months, as ranges of days that reach a file's statistics."""
    ranges: list[list[date]] = []
    for y, m in sorted(pair for pair in months if pair[0] is not None):
        first, after = date(y, m, 1), date(y + m // 12, m % 12 + 1, 1)
        if ranges and ranges[-1][1] == first:
            ranges[-1][1] = after
        else:
            ranges.append([first, after])
    conditions = [
        F.col(day).between(F.lit(first), F.lit(after - timedelta(days=1)))
        for first, after in ranges
    ]
    if (None, None) in months:
        conditions.append(F.col(day).isNull())
    return _any(conditions)
