import datetime as dt

import pytest

from miasma.functions.numeric import ape
from miasma.operators import features, keys, metrics, points, regional
from pyspark.sql import functions as F

CASES = "city STRING, year INT, weekofyear INT, total_cases INT"
WEEKLY = "Weather_Year INT, Weather_Week INT, record_count BIGINT, avg_TEMP DOUBLE, avg_PRCP DOUBLE, avg_DEWP DOUBLE"


def cases(spark, *rows):
    return spark.createDataFrame(list(rows), CASES)


def weekly(spark, *weeks):
    return spark.createDataFrame([(y, w, 7, 20.0, 2.0, None) for y, w in weeks], WEEKLY)


def test_lags_stay_within_a_region_and_cross_years(spark):
    df = features.add_case_lags(cases(
        spark, ("a", 2023, 52, 1), ("a", 2024, 1, 2), ("a", 2024, 2, 3), ("b", 2024, 1, 9)))
    got = {(r.city, r.year, r.weekofyear): (r.lag_cases, r.lag_cases_2, r.lag_cases_3) for r in df.collect()}
    assert got == {("a", 2023, 52): (None,) * 3, ("a", 2024, 1): (1, None, None),
                   ("a", 2024, 2): (2, 1, None), ("b", 2024, 1): (None,) * 3}


def test_feature_rows_fill_nulls_and_drop_weather_keys(spark):
    rows = features.feature_rows(cases(spark, ("a", 2024, 13, 5), ("a", 2024, 14, 6)),
                                 weekly(spark, (2024, 13)))
    row, = rows.collect()
    assert row.year == 2024.0 and row.avg_DEWP == 0.0 and row.lag_cases == 0.0
    assert row.temp_prcp_interaction == 40.0 and row.sin_week == pytest.approx(1.0)
    assert not {"Weather_Year", "Weather_Week"} & set(rows.columns)


def test_left_join_splits_into_matched_and_unmatched(spark):
    joined = features.feature_rows(cases(spark, ("a", 2024, 1, 5), ("a", 2024, 2, 6)),
                                   weekly(spark, (2024, 2)), how="left")
    matched, unmatched = keys.split_matched(joined)
    assert [r.weekofyear for r in matched.collect()] == [2]
    assert [r.weekofyear for r in unmatched.collect()] == [1]


def test_forecast_weeks_also_for_years_without_any_case(spark):
    w, c = weekly(spark, (2024, 1), (2024, 2), (2025, 1)), cases(spark, ("a", 2024, 1, 5), ("b", 2024, 1, 5))
    weeks = keys.unmatched_weeks(w, c)
    assert {tuple(r) for r in weeks.collect()} == {(2024, 2), (2025, 1)}
    assert keys.restrict_to_weeks(w, weeks).count() == 2


def test_forecast_weeks_per_region(spark):
    w = weekly(spark, (2024, 1), (2024, 2)).withColumn("city", F.explode(F.array(F.lit("a"), F.lit("b"))))
    weeks = keys.unmatched_weeks(w, cases(spark, ("a", 2024, 1, 5), ("b", 2024, 2, 5)), ("city",))
    assert {tuple(r) for r in weeks.collect()} == {("a", 2024, 2), ("b", 2024, 1)}
    assert keys.restrict_to_weeks(w, weeks, ("city",)).count() == 2


def test_latest_key_compares_year_and_week_together(spark):
    reference = cases(spark, ("a", 2023, 50, 1), ("a", 2024, 3, 1))
    candidates = cases(spark, ("a", 2023, 51, 1), ("a", 2024, 3, 1), ("a", 2024, 4, 1), ("a", 2025, 1, 1))
    later = keys.after_latest_key(candidates, reference)
    assert {(r.year, r.weekofyear) for r in later.collect()} == {(2024, 4), (2025, 1)}


def test_forecast_lags_zero_or_last_known(spark):
    w = weekly(spark, (2025, 1))
    assert features.forecast_features(w).first().lag_cases == 0.0
    c = cases(spark, ("a", 2024, 50, 5), ("a", 2024, 51, 6), ("a", 2024, 52, 7), ("a", 2024, 49, 4))
    lags = features.last_known_lags(c)
    row = features.forecast_features(w.withColumn("city", F.lit("a")), lags, ("city",)).first()
    assert (row.lag_cases, row.lag_cases_2, row.lag_cases_3) == (7.0, 6.0, 5.0)


def test_percentage_error_skips_weeks_without_cases(spark):
    scored = spark.createDataFrame([("a", 0, 1.0), ("a", 2, 1.0)], "city STRING, total_cases INT, prediction DOUBLE")
    assert scored.select(ape(F.col("total_cases"), F.col("prediction")).alias("e")).collect()[0].e is None
    row = metrics.regression_metrics(scored, keys=("city",)).first()
    assert (row.n, row.mape, row.accuracy) == (2, 50.0, 50.0)
    assert row.r2 == pytest.approx(0.0) and row.rmse == 1.0 and row.mae == 1.0


def test_metrics_overall_in_the_same_pass(spark):
    scored = spark.createDataFrame([("a", 1, 1.0), ("b", 4, 2.0)], "city STRING, total_cases INT, prediction DOUBLE")
    got = {r.city: r.mape for r in metrics.regression_metrics(scored, keys=("city",), overall=True).collect()}
    assert got == {"a": 0.0, "b": 50.0, None: 25.0}


def test_metrics_of_a_region_without_spread(spark):
    scored = spark.createDataFrame([(3, 1.0), (3, 1.0)], "total_cases INT, prediction DOUBLE")
    assert metrics.regression_metrics(scored).first().r2 is None


def test_points(spark):
    df = spark.createDataFrame([("MIDDLE EAST", 2024.0, 5.0, 12.5)], "city STRING, year DOUBLE, weekofyear DOUBLE, prediction DOUBLE")
    nanos = int(dt.datetime(2024, 1, 29, tzinfo=dt.timezone.utc).timestamp()) * 10**9
    assert points.prediction_points(df).first().line == (
        f"predicted_cases,year=2024 weekofyear=5i,predicted_cases=12.5 {nanos}")
    assert points.prediction_points(df, region="city").first().line.startswith(
        "predicted_cases,region=MIDDLE\\ EAST,year=2024 ")
    quality = spark.createDataFrame([(61.5, 38.5)], "accuracy DOUBLE, mape DOUBLE")
    assert points.accuracy_points(quality, 7).first().line == "model_accuracy accuracy=61.5,mape=38.5 7"
    assert quality.select(points.percent_text(F.col("mape")).alias("t")).first().t == "38.50%"


def test_scenarios_change_inputs_and_interaction(spark):
    rows = features.feature_rows(cases(spark, ("a", 2024, 1, 5), ("a", 2024, 2, 6)), weekly(spark, (2024, 2)))
    grid = regional.scenario_grid(rows, [regional.Scenario("as is"),
                                         regional.Scenario("hot", temp_delta=2.0, prcp_factor=0.5, case_factor=3.0)])
    got = {r.scenario: (r.avg_TEMP, r.avg_PRCP, r.lag_cases, r.temp_prcp_interaction) for r in grid.collect()}
    assert got == {"as is": (20.0, 2.0, 5.0, 40.0), "hot": (22.0, 1.0, 15.0, 22.0)}


def test_outbreak_and_baselines(spark):
    df = cases(spark, *[("a", 2024, w, 1) for w in range(1, 10)], ("a", 2024, 10, 50), ("b", 2024, 1, 7), ("b", 2024, 2, 7))
    flagged = {(r.city, r.weekofyear) for r in regional.outbreak_flag(df).filter("outbreak = 1").collect()}
    assert flagged == {("a", 10)}
    naive = regional.seasonal_naive(df.unionByName(cases(spark, ("a", 2025, 10, 3))))
    assert [(r.year, r.weekofyear, r.prediction) for r in naive.filter("prediction IS NOT NULL").collect()] == [(2025, 10, 50.0)]
    line = cases(spark, *[("a", 2024, w, 2 * w) for w in range(1, 9)])
    row = regional.trend_forecast(line, horizon=4).first()
    assert row.slope == pytest.approx(2.0) and row.forecast == pytest.approx(24.0)


def test_risk_uses_the_newest_week(spark):
    scored = spark.createDataFrame([("a", 2023, 52, 4, 9.0), ("a", 2024, 1, 2, 6.0)], CASES + ", prediction DOUBLE")
    row = regional.regional_risk(scored).first()
    assert (row.year, row.weekofyear, row.expected_cases, row.risk) == (2024, 1, 6.0, 2.0)
