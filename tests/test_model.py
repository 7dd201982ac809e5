import pytest
from pyspark.sql import functions as F

from miasma.operators import features, model
from miasma.plans import bootstrap, incremental
from miasma.operators.aggregate import daily_avg, weekly_avg
from miasma.schema import FEATURES

SMALL = {"numTrees": 5, "maxDepth": 4}


@pytest.fixture(scope="module")
def data(spark):
    """Three years of daily weather and weekly cases that follow the temperature."""
    days = spark.range(3 * 364).select(
        F.date_add(F.lit("2020-01-06").cast("date"), F.col("id").cast("int")).alias("DATE"),
        (20 + 10 * F.sin(F.col("id") / 58)).alias("TEMP"),
        (F.col("id") % 5).cast("double").alias("PRCP"), F.lit(10.0).alias("DEWP"))
    weekly = weekly_avg(days, ["TEMP", "PRCP", "DEWP"])
    cases = weekly.filter("Weather_Year < 2022 OR Weather_Week < 30").select(
        F.lit("sj").alias("city"), F.col("Weather_Year").alias("year"),
        F.col("Weather_Week").alias("weekofyear"), F.round("avg_TEMP").cast("int").alias("total_cases"))
    return days, cases


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(5000).select(F.lit("a").alias("city"), F.col("id").cast("int").alias("year"),
                                  (F.col("id") % 53).cast("int").alias("weekofyear"))
    sides = model.hash_split(df)
    again = model.hash_split(df.repartition(7).withColumns({"year": F.col("year").cast("double")}))
    assert sides.exceptAll(again.withColumn("year", F.col("year").cast("int"))).isEmpty()
    assert 900 < sides.filter("is_test").count() < 1100
    left, right = model.random_split(df)
    assert left.count() + right.count() == 5000


def test_vector_keeps_zeros_and_length(spark):
    df = spark.createDataFrame([tuple([0.0] * len(FEATURES))], ", ".join(f"{c} DOUBLE" for c in FEATURES))
    rows = model.feature_array(model.assemble(df))
    assert rows.first().feature_array == [0.0] * len(FEATURES)
    assert [r.length for r in model.feature_lengths(rows).collect()] == [len(FEATURES)]


def test_nulls_are_refused_or_skipped(spark):
    df = spark.createDataFrame([(None, 1.0)], "a DOUBLE, b DOUBLE")
    assert model.assemble(df, ["a", "b"], on_null="skip").count() == 0
    with pytest.raises(Exception):
        model.assemble(df, ["a", "b"]).collect()


def test_forest_is_the_same_whatever_the_layout(spark, data):
    days, cases = data
    rows = features.feature_rows(cases, weekly_avg(days, ["TEMP", "PRCP", "DEWP"]))
    one, other = (model.train_forest(rows.repartition(n), **SMALL) for n in (1, 6))
    trees = lambda forest: forest.toDebugString.split("\n", 1)[1]
    assert trees(one) == trees(other)


def test_load_train_merge_retrain_forecast(spark, data, path):
    days, cases = data
    store = bootstrap.Store(spark, path)
    measures = ["TEMP", "PRCP", "DEWP"]
    early = F.year("DATE") < 2021
    first = bootstrap.bootstrap(store, days.filter(early), cases, measures, **SMALL).first()
    assert first.n > 0 and first.rmse < 10

    before = store.training.read().count()
    incremental.merge_daily(store, daily_avg(days.filter(~early), measures), "late", measures)
    incremental.retrain(store, cases, **SMALL)
    stored = store.training.read()
    assert stored.count() > before
    assert stored.count() == stored.select("year", "weekofyear").distinct().count()
    incremental.retrain(store, cases, **SMALL)
    assert store.training.read().count() == stored.count()

    train, test = store.features(False), store.features(True)
    assert train.join(test, ["city", "year", "weekofyear"], "left_semi").isEmpty()

    forest = model.load_model(spark, store.model_root)
    scored = model.score(forest, train)
    error, spread = scored.select(
        F.sqrt(F.avg((F.col("prediction") - F.col("total_cases")) ** 2)),
        F.stddev_pop("total_cases")).first()
    assert error < spread and scored.filter("prediction < 0").isEmpty()

    forecast = incremental.forecast(store, cases)
    assert min((r.year, r.weekofyear) for r in forecast.collect()) == (2022, 30)
    assert set(forecast.columns) == {"year", "weekofyear", "Prediction Cases"}
    assert forecast.count() == store.weekly.read().count() - cases.count()


def test_saved_model_scores_alike(spark, data, path):
    days, cases = data
    rows = features.feature_rows(cases, weekly_avg(days, ["TEMP", "PRCP", "DEWP"]))
    forest = model.train_forest(rows, **SMALL)
    model.save_model(forest, spark, path)
    model.save_model(forest, spark, path)
    loaded = model.load_model(spark, path)
    assert model.score(forest, rows).exceptAll(model.score(loaded, rows)).isEmpty()
