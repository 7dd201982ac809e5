"""Regions side by side: regional weather and cases, risk, scenarios, outbreak flags, baselines."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from miasma.functions.calendar import week_start_date
from miasma.operators.aggregate import weekly_avg, weighted_merge
from miasma.operators.features import REGION, add_interaction
from miasma.schema import MEASURES, WEEK_KEY


def regional_weekly(obs: DataFrame, station_regions: DataFrame, measures=MEASURES,
                    iso: bool = False) -> DataFrame:
    """Weekly means per region, from a station → region table (STATION, city).

    Observations shrink to station-weeks first, so the join moves weeks instead of readings
    and a station with very many readings is no heavier than any other.
    """
    by_station = weekly_avg(obs, measures, keys=("STATION",), iso=iso)
    located = by_station.join(station_regions.select("STATION", REGION), "STATION")
    return weighted_merge(located, (REGION, *WEEK_KEY), measures)


def regional_risk(scored: DataFrame, predicted: str = "prediction") -> DataFrame:
    """Risk per region: its newest forecast against its mean week.

    The newest week comes from an aggregate over (year, week), not from a sort per region.
    """
    newest = F.max_by(F.col(predicted).cast("double"), F.struct("year", "weekofyear"))
    latest = F.max(F.struct("year", "weekofyear"))
    grouped = scored.groupBy(REGION).agg(
        latest.alias("latest"), newest.alias("expected_cases"),
        F.avg(F.col("total_cases").cast("double")).alias("mean_cases"),
        F.stddev_samp(F.col("total_cases").cast("double")).alias("sd_cases"))
    return grouped.select(
        REGION, F.col("latest.year").alias("year"), F.col("latest.weekofyear").alias("weekofyear"),
        "expected_cases", "mean_cases", "sd_cases",
        F.try_divide("expected_cases", "mean_cases").alias("risk"))


class Scenario(NamedTuple):
    """A change of the inputs: degrees added, factors on precipitation and on known cases."""

    name: str
    temp_delta: float = 0.0
    prcp_factor: float = 1.0
    case_factor: float = 1.0


def scenario_grid(features: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Each feature row once per scenario, inputs changed, ready to score.

    The scenarios are a literal array that is exploded in place: no join, no shuffle.
    """
    options = F.array(*[F.struct(
        F.lit(s.name).alias("name"), F.lit(float(s.temp_delta)).alias("temp_delta"),
        F.lit(float(s.prcp_factor)).alias("prcp_factor"),
        F.lit(float(s.case_factor)).alias("case_factor")) for s in scenarios])
    grid = features.withColumn("scenario_", F.explode(options))
    lags = {c: F.col(c) * F.col("scenario_.case_factor")
            for c in ("lag_cases", "lag_cases_2", "lag_cases_3")}
    changed = grid.withColumns({
        "scenario": F.col("scenario_.name"),
        "avg_TEMP": F.col("avg_TEMP") + F.col("scenario_.temp_delta"),
        "avg_PRCP": F.col("avg_PRCP") * F.col("scenario_.prcp_factor"), **lags})
    return add_interaction(changed).drop("scenario_")


def outbreak_level(cases: DataFrame, sigmas: float = 1.0) -> DataFrame:
    """Per region the count that makes a week an outbreak: mean plus ``sigmas`` deviations."""
    count = F.col("total_cases").cast("double")
    return cases.groupBy(REGION).agg(
        (F.avg(count) + F.lit(float(sigmas)) * F.stddev_samp(count)).alias("threshold"))


def flag_outbreaks(rows: DataFrame, level: DataFrame) -> DataFrame:
    """Add ``threshold`` and the 0/1 flag ``outbreak``.

    Regions without a threshold (fewer than two weeks of history) are left out: nothing can be
    said of them, and a null label would stop a training; ``unflagged`` counts their rows.
    """
    joined = rows.join(level.filter(F.col("threshold").isNotNull()), REGION)
    return joined.withColumn("outbreak", (F.col("total_cases") > F.col("threshold")).cast("int"))


def unflagged(rows: DataFrame, level: DataFrame) -> DataFrame:
    """Rows per region that ``flag_outbreaks`` leaves out."""
    known = level.filter(F.col("threshold").isNotNull()).select(REGION)
    return rows.join(known, REGION, "left_anti").groupBy(REGION).agg(F.count("*").alias("left_out"))


def outbreak_flag(cases: DataFrame, sigmas: float = 1.0) -> DataFrame:
    """Flag the weeks of a case table by its own regional levels."""
    return flag_outbreaks(cases, outbreak_level(cases, sigmas))


def seasonal_naive(cases: DataFrame) -> DataFrame:
    """Forecast a week by the count of the same week a year before in its region.

    Found by key, not by counting rows back, so missing weeks and years with week 53 shift
    nothing. Null where that week has no count.
    """
    before = cases.select(REGION, (F.col("year") + 1).cast(cases.schema["year"].dataType).alias("year"),
                          "weekofyear", F.col("total_cases").cast("double").alias("prediction"))
    return cases.join(before, [REGION, "year", "weekofyear"], "left").select(*cases.columns, "prediction")


def trend_forecast(cases: DataFrame, horizon: int = 4) -> DataFrame:
    """Line fitted to each region's counts and its value ``horizon`` weeks after the last one.

    Time is the date of the week's start in weeks since 1970, so no two weeks share a point.
    """
    t = F.unix_date(week_start_date(F.col("year"), F.col("weekofyear"))) / F.lit(7.0)
    y = F.col("total_cases").cast("double")
    fitted = cases.groupBy(REGION).agg(
        F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept"),
        F.max(t).alias("last_t"))
    return fitted.select(
        REGION, "slope", "intercept",
        (F.col("intercept") + F.col("slope") * (F.col("last_t") + horizon)).alias("forecast"))
