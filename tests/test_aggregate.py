import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from miasma.functions import calendar
from miasma.operators import aggregate, align

PART = "Weather_Year INT, Weather_Week INT, record_count BIGINT, avg_TEMP DOUBLE"


def obs(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), t) for d, t in rows],
                                 "DATE DATE, TEMP DOUBLE")


def test_week_key_pairs_calendar_year_with_iso_week(spark):
    df = obs(spark, [("2024-12-30", 1.0), ("2021-01-01", 1.0)])
    plain = {tuple(r) for r in calendar.with_week_key(df).select("Weather_Year", "Weather_Week").collect()}
    iso = {tuple(r) for r in calendar.with_week_key(df, iso=True).select("Weather_Year", "Weather_Week").collect()}
    assert plain == {(2024, 1), (2021, 53)} and iso == {(2025, 1), (2020, 53)}


def test_week_start_and_monday(spark):
    row = spark.range(1).select(
        calendar.week_start_date(F.lit(2024), F.lit(5)).alias("start"),
        calendar.iso_week_monday(F.lit(dt.date(2024, 12, 31))).alias("monday"),
        calendar.epoch_nanos(F.lit(dt.date(1970, 1, 2))).alias("nanos")).first()
    assert row.start == dt.date(2024, 1, 29) and row.monday == dt.date(2024, 12, 30)
    assert row.nanos == 86_400 * 10**9


def test_merge_weighs_by_readings_not_rows(spark):
    parts = spark.createDataFrame(
        [(2024, 1, 2, 10.0), (2024, 1, 3, None), (2024, 1, 2, 20.0)], PART)
    row = aggregate.weighted_merge(parts, measures=["TEMP"]).first()
    assert (row.record_count, row.avg_TEMP, row.n_TEMP) == (7, 15.0, 4)


def test_merge_of_nothing_but_nulls(spark):
    parts = spark.createDataFrame([(2024, 1, 3, None)], PART)
    row = aggregate.weighted_merge(parts, measures=["TEMP"]).first()
    assert (row.record_count, row.avg_TEMP, row.n_TEMP) == (3, None, 0)


def test_flag_code_is_averaged_as_a_number(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "010000"), (dt.date(2024, 1, 2), "000000"),
                                (dt.date(2024, 1, 3), None)], "DATE DATE, FRSHTT STRING")
    assert aggregate.weekly_avg(df, ["FRSHTT"]).first().avg_FRSHTT == 5000.0


def test_first_load_into_an_empty_table(spark):
    daily = aggregate.daily_avg(obs(spark, [("2024-01-01", 1.0), ("2024-01-02", 3.0)]), ["TEMP"])
    row = aggregate.weekly_upsert(aggregate.empty_weekly(spark, ["TEMP"]), daily, measures=["TEMP"]).first()
    assert (row.Weather_Year, row.Weather_Week, row.record_count, row.avg_TEMP) == (2024, 1, 2, 2.0)


def test_upsert_takes_tables_without_reading_counts(spark):
    old = spark.createDataFrame([(2024, 1, 2, 10.0)], PART)
    new = aggregate.daily_avg(obs(spark, [("2024-01-02", 40.0), ("2024-01-02", None)]), ["TEMP"])
    row = aggregate.weekly_upsert(old, new, measures=["TEMP"]).first()
    assert (row.record_count, row.avg_TEMP, row.n_TEMP) == (4, 20.0, 3)


readings = hs.lists(hs.tuples(hs.integers(0, 20), hs.one_of(hs.none(), hs.integers(-50, 50)),
                              hs.integers(0, 2)), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(readings)
def test_any_grouping_of_deliveries_gives_the_mean_of_all(spark, rows):
    day0 = dt.date(2023, 12, 25)
    df = spark.createDataFrame(
        [(day0 + dt.timedelta(d), None if t is None else float(t), p) for d, t, p in rows],
        "DATE DATE, TEMP DOUBLE, part INT")
    merged = aggregate.empty_weekly(spark, ["TEMP"])
    for p in range(3):
        merged = aggregate.weekly_upsert(
            merged, aggregate.daily_avg(df.filter(F.col("part") == p), ["TEMP"]), measures=["TEMP"])

    def result(weekly):
        return {(r.Weather_Year, r.Weather_Week): r for r in weekly.collect()}

    one_shot, got = result(aggregate.weekly_avg(df, ["TEMP"])), result(merged)
    assert got.keys() == one_shot.keys()
    for key, row in one_shot.items():
        assert (got[key].record_count, got[key].n_TEMP) == (row.record_count, row.n_TEMP)
        if row.avg_TEMP is None:
            assert got[key].avg_TEMP is None
        else:
            assert math.isclose(got[key].avg_TEMP, row.avg_TEMP, rel_tol=1e-12, abs_tol=1e-12)


def test_schema_alignment(spark):
    have = spark.createDataFrame([(1, "x", 2.0)], "a INT, extra STRING, b DOUBLE")
    target = spark.createDataFrame([], "b DOUBLE, c STRING, a BIGINT").schema
    assert align.schema_difference(have, target) == (["extra"], ["c"])
    aligned = align.align_schema(have, target)
    assert aligned.columns == ["b", "c", "a"] and tuple(aligned.first()) == (2.0, None, 1)


def test_changed_years(spark):
    weekly = aggregate.weekly_avg(obs(spark, [("2024-03-01", 1.0), ("2022-03-01", 1.0)]), ["TEMP"])
    assert [r.year for r in aggregate.changed_years(weekly).collect()] == [2022, 2024]


@pytest.mark.parametrize("n_stations", [50])
def test_a_station_with_a_third_of_all_rows(spark, n_stations):
    """Sums stay whole when one station dominates, and its rows shrink before the shuffle."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % n_stations).cast("string").alias("STATION"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 28).cast("int")).alias("DATE"),
        (F.col("id") % 100).cast("double").alias("TEMP"))
    from miasma.operators.regional import regional_weekly
    places = spark.range(n_stations).select(F.col("id").cast("string").alias("STATION"),
                                            F.when(F.col("id") < 10, "a").otherwise("b").alias("city"))
    weekly = regional_weekly(df, places, ["TEMP"])
    plain = (calendar.with_week_key(df.join(places, "STATION"))
             .groupBy("city", "Weather_Year", "Weather_Week")
             .agg(F.count("*").alias("record_count"), F.avg("TEMP").alias("mean")))
    both = weekly.join(plain, ["city", "Weather_Year", "Weather_Week", "record_count"])
    assert both.count() == plain.count() == 8
    assert both.filter(F.abs(F.col("avg_TEMP") - F.col("mean")) > 1e-9).isEmpty()
