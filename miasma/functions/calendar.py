"""Week keys and points in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def week_year(date: Column, iso: bool = False) -> Column:
    """Year of the week key: the calendar year, or with ``iso`` the year the ISO week belongs to."""
    return (F.extract(F.lit("YEAROFWEEK"), date) if iso else F.year(date)).cast("int")


def with_week_key(df: DataFrame, date: str = "DATE", iso: bool = False) -> DataFrame:
    """Add ``Weather_Year`` and ``Weather_Week``.

    The default pairs calendar year with ISO week, as the case files do; 2024-12-30 is then
    week 1 of 2024. ``iso=True`` puts it in week 1 of 2025.
    """
    d = F.col(date)
    return df.withColumns({
        "Weather_Year": week_year(d, iso),
        "Weather_Week": F.weekofyear(d).cast("int"),
    })


def week_start_date(year: Column, week: Column) -> Column:
    """January 1 plus whole weeks: the date at which a weekly value is published."""
    return F.date_add(F.make_date(year.cast("int"), F.lit(1), F.lit(1)), (week.cast("int") - 1) * 7)


def iso_week_monday(date: Column) -> Column:
    return F.date_trunc("week", date).cast("date")


def epoch_nanos(date: Column) -> Column:
    """Nanoseconds since 1970 at midnight UTC; days are counted, so no session zone is involved."""
    return F.unix_date(date.cast("date")).cast("bigint") * F.lit(86_400_000_000_000)


def timestamp_nanos(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000).cast("bigint")
