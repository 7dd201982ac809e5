"""Which weeks to train on and which to forecast: joins on week keys, no key lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from miasma.schema import WEEK_KEY

CASE_WEEK = ["year", "weekofyear"]


def weather_weeks(weekly: DataFrame, keys=()) -> DataFrame:
    """The distinct weeks of a weather table, under the names of the case keys.

    ``keys`` adds columns such as the region.
    """
    weeks = [F.col(w).alias(c) for w, c in zip(WEEK_KEY, CASE_WEEK)]
    return weekly.select(*keys, *weeks).distinct()


def distinct_weeks(df: DataFrame, columns=tuple(CASE_WEEK)) -> DataFrame:
    return df.select(*columns).distinct()


def split_matched(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a left weather join with and without weather."""
    return (joined.filter("has_weather").drop("has_weather"),
            joined.filter("NOT has_weather").drop("has_weather"))


def unmatched_weeks(weekly: DataFrame, cases: DataFrame, keys=()) -> DataFrame:
    """Weather weeks without case counts: the weeks to forecast, with ``keys`` per region."""
    on = [*keys, *CASE_WEEK]
    return weather_weeks(weekly, keys).join(cases.select(*on), on, "left_anti")


def after_latest_key(df: DataFrame, reference: DataFrame, columns=tuple(CASE_WEEK)) -> DataFrame:
    """Rows whose key is later than the latest key of ``reference``.

    Year and week are compared together. The latest key is one row, read as a scalar
    subquery, so nothing is collected and ``df`` is not shuffled.
    """
    latest = reference.agg(F.max(F.struct(*columns)).alias("latest")).scalar()
    return df.filter(F.struct(*columns) > latest)


def restrict_to_weeks(weekly: DataFrame, weeks: DataFrame, keys=()) -> DataFrame:
    """Weekly weather of the given (year, weekofyear) keys, with ``keys`` per region."""
    wanted = weeks.select(*keys, *[F.col(c).alias(w) for w, c in zip(WEEK_KEY, CASE_WEEK)])
    return weekly.join(wanted, [*keys, *WEEK_KEY], "left_semi")


def new_rows(incoming: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """Rows whose key is not stored yet."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")
