"""Seasonal terms, log scale and error terms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKS_PER_YEAR = 52


def sin_week(week: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * week / F.lit(WEEKS_PER_YEAR))


def cos_week(week: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * week / F.lit(WEEKS_PER_YEAR))


def to_log(cases: Column) -> Column:
    return F.log1p(cases.cast("double"))


def from_log(log_cases: Column) -> Column:
    return F.expm1(log_cases)


def ape(actual: Column, predicted: Column) -> Column:
    """Absolute percentage error as a fraction; null where nothing was counted."""
    return F.abs(F.try_divide((actual - predicted).cast("double"), actual.cast("double")))


def number(text: Column) -> Column:
    """Padded decimal text to double; null for anything that is no number."""
    return F.trim(text).try_cast("double")
