"""Region forests, recursive forecasts, least squares and neighbours on small tables."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from miasma.operators import features, geo, model, series
from miasma.operators.aggregate import daily_avg
from miasma.operators.regional import regional_weekly
from miasma.plans import bootstrap, incremental

SMALL = {"numTrees": 8, "maxDepth": 5}
MEASURES = ["TEMP", "PRCP", "DEWP"]


def weeks(n, start=0):
    return [(2015 + i // 52, i % 52 + 1) for i in range(start, start + n)]


@pytest.fixture(scope="module")
def regional(spark):
    """Daily weather of three stations, one per region, and counts that differ by region alone."""
    days = spark.range(3 * 364).select(F.date_add(F.lit("2020-01-06").cast("date"), F.col("id").cast("int")).alias("DATE"))
    obs = days.crossJoin(spark.createDataFrame([("1",), ("2",), ("3",)], "STATION string")).select(
        "STATION", "DATE", F.lit(20.0).alias("TEMP"), F.lit(1.0).alias("PRCP"), F.lit(5.0).alias("DEWP"))
    places = spark.createDataFrame([("1", "low"), ("2", "mid"), ("3", "high")], "STATION string, city string")
    weekly = regional_weekly(obs, places, MEASURES)
    level = F.when(F.col("city") == "low", 5).when(F.col("city") == "mid", 50).otherwise(500)
    cases = (weekly.filter("Weather_Year < 2022 OR Weather_Week < 30")
             .select("city", F.col("Weather_Year").alias("year"), F.col("Weather_Week").alias("weekofyear"),
                     (level + F.col("Weather_Week") % 3).cast("int").alias("total_cases")))
    return obs, places, cases


def test_region_is_a_category(spark, regional, path):
    obs, places, cases = regional
    store = bootstrap.Store(spark, path, regional=True)
    quality = bootstrap.bootstrap(store, obs, cases, MEASURES, places, **SMALL).first()
    assert quality.r2 > 0.9
    loaded = store.model()
    assert isinstance(loaded, PipelineModel) and model.known_regions(loaded) == ["high", "low", "mid"]
    forest = loaded.stages[-1]
    assert forest.numFeatures == len(store.inputs) + 1
    assert f"feature {len(store.inputs)} in {{" in forest.toDebugString  # a split on a set of regions
    rows = store.features(is_test=True)
    unseen = model.score(loaded, rows.withColumn("city", F.lit("nowhere")))
    null = model.score(loaded, rows.withColumn("city", F.lit(None).cast("string")))
    assert unseen.count() == null.count() == rows.count()
    low, high = cases.agg(F.min("total_cases"), F.max("total_cases")).first()
    assert unseen.filter(~F.col("prediction").between(low - 1e-6, high + 1e-6)).isEmpty()
    forecast = incremental.forecast(store, cases)
    assert forecast.count() == store.weekly.read().count() - cases.count()
    assert set(forecast.columns) == {"city", "year", "weekofyear", "Prediction Cases"}


def test_more_regions_than_bins(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("r"), F.col("id") % 40).alias("city"), (2000 + F.col("id") % 5).cast("double").alias("year"),
        (F.col("id") % 50).cast("double").alias("weekofyear"), (F.col("id") % 40).cast("int").alias("total_cases"),
        *[F.lit(0.0).alias(c) for c in model.FEATURES[2:]])
    forest = model.train_region_forest(rows, **SMALL)
    assert len(model.known_regions(forest)) == 40
    assert model.score(forest, rows).agg(F.corr("prediction", "total_cases")).first()[0] > 0.8


def test_region_forest_is_the_same_whatever_the_layout(spark, regional):
    obs, places, cases = regional
    rows = features.feature_rows(cases, regional_weekly(obs, places, MEASURES), regional=True)
    one, other = (model.train_region_forest(rows.repartition(n), **SMALL) for n in (1, 6))
    trees = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    assert trees(one) == trees(other)


def test_forecasts_become_lags(spark, path):
    """Two regions: weeks to come, and a gap week inside the history whose forecast is a lag later on."""
    store = bootstrap.Store(spark, path, regional=True)
    known = {"a": [1, 2, 3, 4, 6, 7], "b": [1]}
    weather = [(c, 2020, w) for c, n in (("a", 10), ("b", 4)) for w in range(1, n + 1)]
    daily = spark.createDataFrame([(c, dt.date(2020, 1, 1) + dt.timedelta(7 * (w - 1)), 1.0) for c, _, w in weather],
                                  "city string, DATE date, TEMP double").withColumns({"PRCP": F.lit(1.0), "DEWP": F.lit(1.0)})
    store.weekly.replace(daily_avg(daily, MEASURES, keys=("city",)).drop("DATE"))
    cases = spark.createDataFrame([(c, 2020, w, 10 * w) for c, ws in known.items() for w in ws],
                                  "city string, year int, weekofyear int, total_cases int")
    newest = lambda rows: rows.withColumn("prediction", F.col("lag_cases") + 1)
    got = {(r.city, int(r.weekofyear)): ([r.lag_cases, r.lag_cases_2, r.lag_cases_3], r.scored_lags)
           for r in incremental.recursive_forecast(store, cases, newest).collect()}
    assert got == {
        ("a", 5): ([40, 30, 20], [False, False, False]),
        ("a", 8): ([70, 60, 41], [False, False, True]),
        ("a", 9): ([71, 70, 60], [True, False, False]),
        ("a", 10): ([72, 71, 70], [True, True, False]),
        ("b", 2): ([10, 0, 0], [False]),
        ("b", 3): ([11, 10, 0], [True, False]),
        ("b", 4): ([12, 11, 10], [True, True, False])}
    full = spark.createDataFrame([(c, 2020, w, 1) for c, _, w in weather], cases.schema)
    assert incremental.recursive_forecast(store, full, newest).count() == 0
    with pytest.raises(ValueError):
        incremental.recursive_forecast(bootstrap.Store(spark, path + "-plain"), cases, newest)


def test_coefficients_equal_numpy(spark):
    draw, rows = np.random.default_rng(2), []
    for city in ("x", "y"):
        rows += [(city, y, w, int(40 + 9 * math.sin(w / 8) + draw.integers(0, 12))) for y, w in weeks(200)]
    cases = spark.createDataFrame(rows, "city string, year int, weekofyear int, total_cases int")
    lagged, terms = features.add_case_lags(cases), series.terms(2, series.LAGS)
    fitted = {r.city: r for r in series.fit_series(lagged, terms).collect()}
    used = lagged.select("city", "total_cases", *[c.alias(n) for n, c in terms.items()]).dropna().toPandas()
    for city, part in used.groupby("city"):
        x, y = part[list(terms)].to_numpy(float), part.total_cases.to_numpy(float)
        best, rest, *_ = np.linalg.lstsq(x, y, rcond=None)
        assert fitted[city].n == 197
        assert np.allclose(fitted[city].coefficients, best, rtol=1e-6, atol=1e-6)
        assert math.isclose(fitted[city].sse, rest[0], rel_tol=1e-6)
    scored = series.predict_series(series.fit_series(lagged, terms), lagged, terms)
    assert scored.count() == 400 and scored.filter("prediction IS NULL").count() == 6  # no three counts before


def test_terms_that_depend_on_others_get_no_weight(spark):
    rows = [("a", 2020, 1, 7), ("b", 2020, 1, 3), ("b", 2020, 2, 3), ("b", 2020, 3, None)]
    cases = spark.createDataFrame(rows, "city string, year int, weekofyear int, total_cases int")
    terms = series.terms(1) | {"twice": F.lit(2.0), "nothing": F.lit(0.0)}
    for r in series.fit_series(cases, terms).collect():
        assert r.n == (1 if r.city == "a" else 2)
        assert r.coefficients[-2:] == [0, 0] and all(map(math.isfinite, r.coefficients)) and r.sse < 1e-9
    assert series.fit_series(cases.limit(0), terms).count() == 0


def test_weeks_after_the_last_count(spark):
    cases = spark.createDataFrame([("a", 2020, 51, 1), ("b", 2020, 53, 1), ("b", 2019, 3, 1)], "city string, year int, weekofyear int, total_cases int")
    got = {(r.city, r.year, r.weekofyear) for r in series.weeks_after(cases, 2).collect()}
    assert got == {("a", 2020, 52), ("a", 2021, 1), ("b", 2021, 1), ("b", 2021, 2)}


@pytest.mark.parametrize("radius", [50.0, 700.0, 6000.0, 30000.0])
def test_near_places_equal_all_pairs(spark, radius):
    draw = np.random.default_rng(5)
    rows = [(f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(draw.uniform(-90, 90, 60), draw.uniform(-180, 180, 60)))]
    rows += [("north", 90.0, 0.0), ("near north", 89.8, 170.0), ("east", 10.0, 179.9), ("west", 10.0, -179.9), ("same", 10.0, 179.9),
             ("lost", None, 3.0)]
    places = spark.createDataFrame(rows, "city string, latitude double, longitude double")

    def km(a, b):
        p, q = (np.radians(x[1:]) for x in (a, b))
        h = math.sin((q[0] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(q[0]) * math.sin((q[1] - p[1]) / 2) ** 2
        return 2 * geo.EARTH_KM * math.asin(math.sqrt(min(h, 1.0)))

    expected = {(a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and None not in a + b and km(a, b) <= radius}
    got = [(r.city, r.neighbour) for r in geo.near_places(places, radius).collect()]
    assert sorted(got) == sorted(expected)
    assert ("east", "west") in expected and ("same", "east") in expected and ("north", "near north") in expected
    with pytest.raises(ValueError):
        geo.near_places(places, 0)


def test_near_places_make_no_cross_join(spark):
    places = spark.createDataFrame([("a", 1.0, 1.0)], "city string, latitude double, longitude double")
    plan = geo.near_places(places, 10)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_neighbours_as_inputs(spark, regional, path):
    obs, places, cases = regional
    near = spark.createDataFrame([("low", "mid", 1.0), ("low", "high", 2.0), ("mid", "low", 1.0)], "city string, neighbour string, km double")
    rows = features.feature_rows(cases, regional_weekly(obs, places, MEASURES), regional=True)
    got = {(r.city, int(r.year), int(r.weekofyear)): (r.neighbour_cases, r.neighbours)
           for r in geo.add_neighbour_lags(rows, cases, near).collect()}
    count = {(r.city, r.year, r.weekofyear): r.total_cases for r in cases.collect()}
    assert got["low", 2020, 5] == ((count["mid", 2020, 4] + count["high", 2020, 4]) / 2, 2)
    assert got["mid", 2020, 5] == (count["low", 2020, 4], 1)
    assert got["high", 2020, 5] == (0, 0)
    store = bootstrap.Store(spark, path, regional=True, near=near)
    assert bootstrap.bootstrap(store, obs, cases, MEASURES, places, **SMALL).first().r2 > 0.9
    assert store.model().stages[-1].numFeatures == len(model.FEATURES) + 3
    wanted = store.weekly.read().count() - cases.count()
    assert incremental.forecast(store, cases).count() == wanted
    assert incremental.recursive_forecast(store, cases).count() == wanted
    with pytest.raises(ValueError):
        bootstrap.Store(spark, path, near=near)


def test_lags_by_week_do_not_move_over_missing_weeks(spark):
    rows = [("a", 2020, w, w) for w in (1, 2, 5, 52, 53)] + [("a", 2021, 1, 100), ("a", 2021, 2, 101), ("b", 2021, 2, 7)]
    cases = spark.createDataFrame(rows, "city string, year int, weekofyear int, total_cases int")
    got = {tuple(r)[:3]: tuple(r)[4:] for r in features.add_case_lags_by_week(cases).collect()}
    assert got["a", 2020, 2] == (1, None, None) and got["a", 2020, 5] == (None, None, 2)
    assert got["a", 2021, 1] == (53, 52, None) and got["a", 2021, 2] == (100, 53, 52) and got["b", 2021, 2] == (None, None, None)
    assert features.add_case_lags_by_week(cases.limit(0)).count() == 0
    doubles = cases.withColumns({c: F.col(c).cast("double") for c in ("year", "weekofyear")})
    assert features.add_case_lags_by_week(doubles).filter("lag_cases = 100").count() == 1


def test_folds_never_see_later_weeks(spark, regional):
    obs, places, cases = regional
    rows = features.feature_rows(cases, regional_weekly(obs, places, MEASURES), regional=True)
    cuts = [(2021, 1), (2021, 27), (2000, 1), (2030, 1)]
    scored = model.rolling_evaluation(rows, cuts, fit=model.train_region_forest, **SMALL)
    by_fold = {r.fold: r for r in scored.groupBy("fold").agg(
        F.count("*").alias("n"), F.max("n_train").alias("n_train"), F.max("train_until").alias("until"),
        F.min(F.struct(F.col("year").cast("int"), F.col("weekofyear").cast("int"))).alias("first")).collect()}
    assert sorted(by_fold) == [2, 3]
    assert all(tuple(r.until) < tuple(r["first"]) for r in by_fold.values())
    assert by_fold[3].n_train == by_fold[2].n_train + by_fold[2].n
    nothing = model.rolling_evaluation(rows, [(2000, 1)], **SMALL)
    assert nothing.count() == 0 and "prediction" in nothing.columns
