"""Cases in which a wrong answer once went unnoticed."""

import pytest
from pyspark.sql import functions as F

from miasma.operators import clean, features, model, points, regional
from miasma.schema import RAW_COLUMNS, RAW_DDL
from miasma.sinks import tables
from miasma.sources import files, payload

CASES = "city string, year int, weekofyear int, total_cases int"


def cases(spark, *rows):
    return spark.createDataFrame(list(rows), CASES)


def test_a_reading_beats_a_missing_value(spark):
    df = spark.createDataFrame([("a", "2020-01-01", None, 2.0, "010000"), ("a", "2020-01-01", 5.0, 3.0, "000010"),
                                ("b", "2020-01-01", None, None, None)],
                               "STATION string, DATE string, TEMP double, PRCP double, FRSHTT string")
    got = {r.STATION: tuple(r)[2:] for r in clean.dedupe_observations(df).collect()}
    assert got == {"a": (5.0, 2.0, "000010"), "b": (None, None, None)}
    numbers = clean.dedupe_observations(df.drop("FRSHTT"))
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_blank_stations_and_cut_lines_are_rejected_and_reported_alike(spark):
    def line(*fields):
        return ",".join(f'"{f}"' for f in fields)

    full = ["01", "2024-12-03", *["1"] * (len(RAW_COLUMNS) - 2)]
    lines = [line(*full), line(" ", *full[1:]), line("02", "2024-12-03"), line("STATION", "DATE", *full[2:]),
             line("03", "someday", *full[2:]), line("04")]
    raw = payload.decode_payload(spark.createDataFrame([(bytearray(x.encode()),) for x in lines], "value binary"))
    assert [r.STATION for r in clean.clean_records(raw).collect()] == ["01"]
    assert {r.reason: r.records for r in clean.reject_report(raw).collect()} == {
        "no station": 1, "short line": 2, "header": 1, "bad date": 1}
    assert len(RAW_DDL.split(",")) == len(RAW_COLUMNS)


def test_a_line_cut_anywhere_is_kept_aside_with_its_text(spark, tmp_path):
    fields = [f'"{c}, {i}"' if c == "NAME" else f'"{i}"' for i, c in enumerate(RAW_COLUMNS)]
    fields[1] = '"2024-12-03"'
    name = RAW_COLUMNS.index("NAME")
    cut = [",".join(fields[:k]) for k in range(1, len(RAW_COLUMNS))]
    whole = [",".join(fields), ",".join([*fields[:2], *['""'] * 26]), ",".join([*fields[:2], *[""] * 26]),
             ",".join([*fields[:name], '"A \\"B\\", C"', *fields[name + 1:]])]
    long, no_date = ",".join([*fields, '"1"']), ",".join([fields[0], '""', *fields[2:]])
    lines = [*cut, *whole, long, no_date]
    raw = payload.decode_payload(spark.createDataFrame([(bytearray(x.encode()),) for x in lines], "value binary"), keep_text=True)
    got = sorted(tuple(r) for r in clean.quarantine(raw).collect())
    assert got == sorted([("short line", k, t) for k, t in enumerate(cut, start=1)] + [("long line", 29, long), ("no date", 28, no_date)])
    kept = clean.clean_records(raw.drop("line"))
    assert kept.count() == len(whole) and "damaged_line" not in kept.columns
    (tmp_path / "a.csv").write_text("\n".join([",".join(f'"{c}"' for c in RAW_COLUMNS), *lines]) + "\n")
    of_file = files.read_observation_csv(spark, str(tmp_path / "a.csv"))
    assert {r.reason: r.records for r in clean.reject_report(of_file).collect()} == {"short line": 27, "long line": 1, "no date": 1}
    assert clean.clean_records(of_file).count() == len(whole)


def test_fields_of_rejected_lines_are_counted_once(spark):
    long = '"' + "x," * 20000 + '"'
    lines = ['"01","2024-12-03"', f'"01",{long}', '"01","a\\",b', '"01"\n"2",3', '"a"b,"c,d",,"', ",,"]
    raw = payload.decode_payload(spark.createDataFrame([(bytearray(x.encode()),) for x in lines], "value binary"), keep_text=True)
    rejected = clean.quarantine(raw)
    assert {r.text: r.fields for r in rejected.collect()} == dict(zip(lines, [2, 2, 3, 2, 4, 3]))
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(line") == 1 and plan.count("short line") == 1


def test_points_without_a_value_are_left_out_and_counted(spark):
    quality = spark.createDataFrame([("a b", 90.0, 10.0), ("c", None, None)], "city string, accuracy double, mape double")
    got = [r.line for r in points.accuracy_points(quality, 7, region="city").collect()]
    assert got == ["model_accuracy,region=a\\ b accuracy=90.0,mape=10.0 7"]
    assert points.without_value(quality, "accuracy", "mape").first().left_out == 1
    forecast = spark.createDataFrame([(2024, 1, None), (2024, 2, 3.0)], "year int, weekofyear int, prediction double")
    assert points.prediction_points(forecast).count() == 1


def test_seasonal_forecast_takes_the_same_week_of_the_year_before(spark):
    rows = [("a", y, w, y * 100 + w) for y in (2019, 2020, 2021) for w in range(1, 54) if (y, w) not in ((2020, 7), (2019, 53))]
    got = {(r.year, r.weekofyear): r.prediction for r in regional.seasonal_naive(cases(spark, *rows)).collect()}
    assert got[2021, 2] == 202002 and got[2021, 7] is None and got[2021, 53] == 202053 and got[2020, 53] is None
    assert len(got) == len(rows)


def test_trend_axis_tells_week_53_from_week_1(spark):
    two = cases(spark, ("a", 2020, 53, 1), ("a", 2021, 1, 3))
    assert regional.trend_forecast(two).first().slope is not None


def test_lags_of_a_gap_week_come_from_before_it(spark):
    known = cases(spark, ("a", 2020, 1, 4), ("a", 2020, 2, 5), ("a", 2021, 1, 999), ("b", 2020, 1, 7))
    weeks = spark.createDataFrame([("a", 2020, 10), ("a", 2021, 5), ("b", 2019, 1), ("c", 2020, 1)], "city string, year int, weekofyear int")
    got = {(r.city, r.year, r.weekofyear): (r.lag_cases, r.lag_cases_2, r.lag_cases_3) for r in features.as_of_lags(weeks, known).collect()}
    assert got == {("a", 2020, 10): (5.0, 4.0, None), ("a", 2021, 5): (999.0, 5.0, 4.0), ("b", 2019, 1): (None,) * 3, ("c", 2020, 1): (None,) * 3}


def test_append_new_stores_a_repeated_key_once(spark, path):
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(path)
    tables.append_new(spark.createDataFrame([(1, "new"), (2, "a"), (2, "b")], "k int, v string"), path, ["k"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]


def test_regions_without_threshold_do_not_stop_a_fit_and_one_class_scores_zero(spark):
    rows = cases(spark, *[("a", 2020, w, 5) for w in range(1, 20)], ("b", 2020, 1, 3))
    flagged = regional.outbreak_flag(rows)
    assert {r.city for r in flagged.collect()} == {"a"}
    assert regional.unflagged(rows, regional.outbreak_level(rows)).first().left_out == 1
    inputs = flagged.select("city", "year", "weekofyear", "outbreak", *[F.lit(1.0).alias(c) for c in ("x", "y")])
    forest = model.train_outbreak_classifier(inputs, features=["x", "y"], numTrees=2, maxDepth=2)
    got = model.detect_outbreak(forest, inputs, ["x", "y"]).select("outbreak_probability").distinct().collect()
    assert [r[0] for r in got] == [0.0]


@pytest.mark.parametrize("year,week,day", [(2024, 5, "2024-01-29"), (2020, 53, "2020-12-30"), (2021, 1, "2021-01-01")])
def test_week_starts(spark, year, week, day):
    from miasma.functions.calendar import week_start_date
    assert str(spark.range(1).select(week_start_date(F.lit(year), F.lit(week))).first()[0]) == day


WEEKLY = "Weather_Year int, Weather_Week int, record_count bigint, avg_TEMP double, n_TEMP bigint"


def test_a_stream_does_not_mistake_other_versions_for_its_batches(spark, path):
    from miasma.streaming import upsert

    table = tables.VersionedTable(spark, path)
    table.replace(spark.createDataFrame([(2024, 1, 2, 1.0, 2)], WEEKLY))
    news = spark.createDataFrame([(2024, 2, 1, 5.0, 1)], WEEKLY)
    for stream in ("a", "a", "b"):  # a replay, then another stream with the same batch number
        upsert.upsert_batch(table, ["TEMP"], stream)(news, 0)
    assert {r.Weather_Week: r.record_count for r in table.read().collect()} == {1: 2, 2: 2}


def test_a_second_writer_of_a_version_fails_and_changes_nothing(spark, path):
    table = tables.VersionedTable(spark, path)
    rows = spark.createDataFrame([(2024, 1, 2, 1.0, 2)], WEEKLY)
    table.write(rows, 0)
    with pytest.raises(tables.ConcurrentWrite):
        table.write(rows.withColumn("avg_TEMP", F.lit(9.0)), 0)
    assert table.log.latest() == 0 and [r.avg_TEMP for r in table.read().collect()] == [1.0]


def test_a_regional_table_refuses_deliveries_without_region(spark):
    from miasma.operators import aggregate

    plain = aggregate.empty_weekly(spark, ["TEMP"])
    by_region = aggregate.empty_weekly(spark, ["TEMP"], ("city", "Weather_Year", "Weather_Week"))
    for table, delivery, keys in ((by_region, plain, ("city", "Weather_Year", "Weather_Week")),
                                  (plain, by_region, ("Weather_Year", "Weather_Week"))):
        with pytest.raises(ValueError, match="keys"):
            aggregate.weekly_upsert(table, delivery, keys, ["TEMP"])


def test_merging_keeps_sums_exact(spark):
    from miasma.operators import aggregate

    values = [0.1 * i for i in range(1, 40)]
    obs = spark.createDataFrame([("2024-01-01", v) for v in values], "DATE string, TEMP double").withColumn("DATE", F.col("DATE").cast("date"))
    daily = aggregate.daily_avg(obs.coalesce(1), ["TEMP"])
    again = aggregate.weighted_merge(daily, measures=["TEMP"]).first()
    assert again.s_TEMP == daily.first().s_TEMP and again.avg_TEMP == daily.first().avg_TEMP


def test_plain_means_take_one_exchange(spark):
    from miasma.plans import standins

    import os
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    from miasma.operators import aggregate
    weekly = aggregate.weekly_avg(standins.observations(spark, "/root/testdata/sf0.001"), ["TEMP"])
    plan = weekly._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
