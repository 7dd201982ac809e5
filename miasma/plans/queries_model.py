"""Queries that train and use forests, and those on the steps around them.

A forest's numbers have no SQL form, but much about them has: which keys are scored, how many rows
a stage holds, labels, bounds that hold for any forest, and that a stored model scores as before.
Each query returns such facts of the full forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from miasma.operators import aggregate, model, regional
from miasma.plans import bootstrap, incremental
from miasma.plans import standins as st
from miasma.plans.registry import query
from miasma.schema import CASE_KEY, FEATURES, MEASURES, WEEK_KEY
from miasma.session import shared_dir
from miasma.sinks import tables
from miasma.streaming import upsert
from miasma.streaming.sources import stream_parquet

USED = ["TEMP", "PRCP", "DEWP"]
OBS, CASES, WEEKLY = st.SQL_OBS, st.SQL_CASES, st.SQL_WEEKLY
ALL = f"{OBS}, {WEEKLY}, {CASES}, {st.SQL_LAGGED}, {st.SQL_FEATURES}"
_IS_TEST = "('0x' || substr(md5('1947|' || city || '|' || CAST(year AS INTEGER) || '|' || CAST(weekofyear AS INTEGER)), 1, 8))::BIGINT % 100 < 20"
_PLACE = """place AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS "STATION", r_name AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_REGIONAL = f"""{_PLACE}, regional AS (SELECT city, "Weather_Year" AS year, "Weather_Week" AS weekofyear, count(*) AS record_count,
    {", ".join(f'avg(CAST("{m}" AS DOUBLE)) AS "avg_{m}", count("{m}") AS "n_{m}"' for m in MEASURES)}
  FROM obs JOIN place USING ("STATION") GROUP BY ALL)"""


def _cases(spark, sf_dir):
    return st.stored(spark, st.weekly_cases(spark, sf_dir), "cases")


def _store(spark, sf_dir, cases=None):
    """Stored weekly means and feature rows."""
    store = bootstrap.Store(spark, shared_dir(spark, "store"))
    store.weekly.replace(aggregate.weekly_avg(st.observations(spark, sf_dir), USED))
    store.put_features(store.feature_rows(st.weekly_cases(spark, sf_dir) if cases is None else cases))
    return store


def _regional_store(spark, sf_dir, cases):
    """Weekly means per region, their feature rows and a forest, stored."""
    store = bootstrap.Store(spark, shared_dir(spark, "regional-store"), regional=True)
    store.weekly.replace(regional.regional_weekly(
        st.observations(spark, sf_dir), st.station_regions(spark, sf_dir), USED))
    store.put_features(store.feature_rows(cases))
    store.train()
    return store


def _in_bounds(scored, train, predicted="prediction"):
    """Add ``in_bounds``: a forest's mean lies between the smallest and largest count it has seen."""
    count = F.col("total_cases").cast("double")
    low, high = (train.agg(f(count)).scalar() for f in (F.min, F.max))
    return scored.withColumn("in_bounds", F.col(predicted).between(low - 1e-6, high + 1e-6))


def _week(*columns):
    return [*columns, F.col("year").cast("int").alias("year"), F.col("weekofyear").cast("int").alias("weekofyear")]


@query(f"""WITH {ALL} SELECT city, CAST(year AS INTEGER) AS year, CAST(weekofyear AS INTEGER) AS weekofyear, total_cases,
    TRUE AS in_bounds FROM features WHERE {_IS_TEST}""")
def rf_train_predict(spark, sf_dir):
    """The full forest, trained on one side of the split and applied to the other."""
    store = _store(spark, sf_dir)
    train, test = store.features(is_test=False), store.features(is_test=True)
    scored = _in_bounds(model.score(model.train_forest(train), test), train)
    return scored.select(*_week("city"), "total_cases", "in_bounds")


@query(f"""WITH {ALL} SELECT city, count(*) AS n, CAST(0 AS BIGINT) AS changed FROM features WHERE {_IS_TEST} GROUP BY city""")
def rf_save_load(spark, sf_dir):
    """A stored forest, loaded again: test rows per region and how many of them score otherwise."""
    store = _store(spark, sf_dir)
    test, forest = store.features(is_test=True), model.train_forest(store.features(is_test=False))
    model.save_model(forest, spark, store.model_root)
    loaded = model.load_model(spark, store.model_root)
    before = model.score(forest, test).select(*CASE_KEY, F.col("prediction").alias("before"))
    both = model.score(loaded, test).join(before, CASE_KEY)
    return both.groupBy("city").agg(F.count("*").alias("n"), F.count_if(F.col("before") != F.col("prediction")).alias("changed"))


@query(f"""WITH {ALL} SELECT 'first load' AS stage, count(*) AS n, TRUE AS agrees FROM features WHERE {_IS_TEST} AND year <= 1998
  UNION ALL SELECT 'retrained', count(*), TRUE FROM features WHERE {_IS_TEST}""")
def rf_retrain(spark, sf_dir):
    """First load with weather up to 1998, then the rest merged in, twice: test rows per stage, and
    whether the reported errors are those of the scored rows."""
    obs, cases = st.observations(spark, sf_dir), _cases(spark, sf_dir)
    store = bootstrap.Store(spark, shared_dir(spark, "store"))
    early = F.year("DATE") <= 1998
    before = bootstrap.bootstrap(store, obs.filter(early), cases, USED)
    before = st.stored(spark, before.select(F.lit("first load").alias("stage"), "n", _agrees(store).alias("agrees")), "metrics")
    rest = aggregate.daily_avg(obs.filter(~early), USED)
    for _ in range(2):
        incremental.merge_daily(store, rest, "after 1998", USED)
    incremental.retrain(store, cases)
    after = bootstrap.evaluate(store).select(F.lit("retrained").alias("stage"), "n", _agrees(store).alias("agrees"))
    return before.unionByName(after)


def _agrees(store):
    """Whether RMSE and R² of ``evaluate`` equal those worked out from sums over the scored rows."""
    rows = model.score(model.load_model(store.spark, store.model_root), store.features(is_test=True))
    a, p = F.col("total_cases").cast("double"), F.col("prediction")
    plain = rows.agg(F.count("*").alias("n"), F.sum(a).alias("a"), F.sum(a * a).alias("aa"), F.sum((a - p) * (a - p)).alias("e"))
    plain = plain.select(F.sqrt(F.col("e") / F.col("n")).alias("rmse"),
                         (1 - F.col("e") / (F.col("aa") - F.col("a") * F.col("a") / F.col("n"))).alias("r2")).first()
    return (F.abs(F.col("rmse") - plain.rmse) < 1e-6) & (F.abs(F.col("r2") - plain.r2) < 1e-6)


@query(f"""WITH {OBS}, {WEEKLY}, {CASES} SELECT "Weather_Year" AS year, "Weather_Week" AS weekofyear, TRUE AS in_bounds
  FROM weekly WHERE NOT EXISTS (SELECT 1 FROM cases WHERE year = "Weather_Year" AND weekofyear = "Weather_Week")""")
def rf_forecast(spark, sf_dir):
    """Forecast of the weather weeks that have no cases."""
    cases = _cases(spark, sf_dir)
    store = _store(spark, sf_dir, cases)
    train = store.features(is_test=False)
    model.save_model(model.train_forest(train), spark, store.model_root)
    scored = _in_bounds(incremental.forecast(store, cases), train, "Prediction Cases")
    return scored.select(*_week(), "in_bounds")


@query(f"""WITH {ALL}, scenarios(scenario) AS (VALUES ('as is'), ('warmer'), ('wetter'), ('spreading'))
  SELECT city, scenario, count(*) AS weeks, TRUE AS in_bounds FROM features, scenarios WHERE {_IS_TEST} GROUP BY city, scenario""")
def rf_scenarios(spark, sf_dir):
    """Forecasts per region when weather and cases change."""
    store = _store(spark, sf_dir)
    train, test = store.features(is_test=False), store.features(is_test=True)
    grid = regional.scenario_grid(test, [
        regional.Scenario("as is"), regional.Scenario("warmer", temp_delta=2.0),
        regional.Scenario("wetter", prcp_factor=1.5), regional.Scenario("spreading", case_factor=2.0)])
    scored = _in_bounds(model.score(model.train_forest(train), grid), train)
    return scored.groupBy("city", "scenario").agg(F.count("*").alias("weeks"), F.every("in_bounds").alias("in_bounds"))


@query(f"""WITH {ALL}, level AS (SELECT city, avg(total_cases) + stddev_samp(total_cases) AS threshold
    FROM features WHERE NOT ({_IS_TEST}) GROUP BY city)
  SELECT city, CAST(year AS INTEGER) AS year, CAST(weekofyear AS INTEGER) AS weekofyear, total_cases,
    CAST(total_cases > threshold AS INTEGER) AS outbreak, TRUE AS fits
  FROM features JOIN level USING (city) WHERE {_IS_TEST} AND threshold IS NOT NULL""")
def rf_outbreak(spark, sf_dir):
    """Outbreak weeks told apart by a stored classifier; ``fits``: the class follows its probability."""
    store = _store(spark, sf_dir)
    train, test = store.features(is_test=False), store.features(is_test=True)
    level = regional.outbreak_level(train)
    labelled = st.stored(spark, regional.flag_outbreaks(train, level), "labelled")
    model.save_model(model.train_outbreak_classifier(labelled), spark, store.model_root)
    loaded = model.load_model(spark, store.model_root, RandomForestClassificationModel)
    scored = model.detect_outbreak(loaded, regional.flag_outbreaks(test, level))
    chance = F.col("outbreak_probability")
    fits = chance.between(0, 1) & ((chance == 0.5) | ((chance > 0.5) == (F.col("predicted_outbreak") == 1)))
    return scored.select(*_week("city"), "total_cases", "outbreak", fits.alias("fits"))


@query(f"""WITH {OBS}, {CASES}, {_REGIONAL} SELECT city, count(*) AS n, TRUE AS fits
  FROM cases JOIN regional USING (city, year, weekofyear) WHERE {_IS_TEST} GROUP BY city""")
def rf_regional_metrics(spark, sf_dir):
    """A forest on the weather of each region: test rows per region, and whether errors are in order."""
    store = _regional_store(spark, sf_dir, st.weekly_cases(spark, sf_dir))
    found = bootstrap.evaluate(store, keys=("city",))
    fits = (F.col("mae") <= F.col("rmse") + 1e-9) & F.coalesce(F.col("r2") <= 1, F.lit(True))
    return found.select("city", "n", fits.alias("fits"))


_AHEAD = f"""{OBS}, {CASES}, {_REGIONAL}, ahead AS (SELECT * FROM regional ANTI JOIN cases USING (city, year, weekofyear))"""


@query(f"""WITH {_AHEAD} SELECT city, year, weekofyear, TRUE AS in_bounds FROM ahead""")
def rf_regional_forecast(spark, sf_dir):
    """Weeks without cases forecast per region, from its own weather and the counts before them."""
    cases = _cases(spark, sf_dir)
    store = _regional_store(spark, sf_dir, cases)
    scored = incremental.forecast(store, cases)
    return _in_bounds(scored, store.features(is_test=False), "Prediction Cases").select(*_week("city"), "in_bounds")


# ---- the steps around the forests ----

def _lag_sql(k: int) -> str:
    return (f"coalesce((SELECT c.total_cases::DOUBLE FROM cases c WHERE c.city = ahead.city AND c.year * 100 + c.weekofyear < "
            f"ahead.year * 100 + ahead.weekofyear ORDER BY c.year DESC, c.weekofyear DESC LIMIT 1 OFFSET {k}), 0)")


@query(f"""WITH {_AHEAD} SELECT city, year, weekofyear, round(coalesce("avg_TEMP", 0), 8) AS "avg_TEMP",
    {_lag_sql(0)} AS lag_cases, {_lag_sql(1)} AS lag_cases_2, {_lag_sql(2)} AS lag_cases_3 FROM ahead""")
def regional_forecast_features(spark, sf_dir):
    """Feature rows of the weeks to forecast per region, gap weeks included, lags as of each week."""
    store = bootstrap.Store(spark, shared_dir(spark, "regional-store"), regional=True)
    store.weekly.replace(regional.regional_weekly(
        st.observations(spark, sf_dir), st.station_regions(spark, sf_dir), USED))
    rows = incremental.forecast_rows(store, _cases(spark, sf_dir))
    return rows.select(*_week("city"), F.round("avg_TEMP", 8).alias("avg_TEMP"), "lag_cases", "lag_cases_2", "lag_cases_3")


def _halves(spark, sf_dir):
    """All observations in two deliveries that share most weeks."""
    obs = st.observations(spark, sf_dir)
    rainy = F.substring("FRSHTT", 2, 1) == "1"
    return obs.filter(~rainy), obs.filter(rainy)


def _all_means(weekly, *keys):
    return weekly.select(*keys, *WEEK_KEY, "record_count", *[F.round(f"avg_{m}", 8).alias(f"avg_{m}") for m in MEASURES],
                         *[f"n_{m}" for m in MEASURES])


_MEANS_SQL = ", ".join(f'round("avg_{m}", 8) AS "avg_{m}", "n_{m}"' for m in MEASURES)


@query(f"""WITH {OBS}, {_REGIONAL} SELECT city, year AS "Weather_Year", weekofyear AS "Weather_Week", record_count, {_MEANS_SQL} FROM regional""")
def regional_merge(spark, sf_dir):
    """Two deliveries merged into a regional table, the second of them twice: all 16 measures."""
    places = st.station_regions(spark, sf_dir)
    store = bootstrap.Store(spark, shared_dir(spark, "regional-store"), regional=True)
    first, second = (regional.regional_weekly(part, places) for part in _halves(spark, sf_dir))
    store.weekly.replace(first)
    for _ in range(2):
        incremental.merge_daily(store, second, "second")
    return _all_means(store.weekly.read(), "city")


@query(f"""WITH {OBS}, {WEEKLY} SELECT "Weather_Year", "Weather_Week", record_count, {_MEANS_SQL} FROM weekly""")
def stream_upsert_after_bootstrap(spark, sf_dir):
    """A table with versions of its own takes in a stream, a replayed batch and a second stream."""
    first, second = _halves(spark, sf_dir)
    table = tables.VersionedTable(spark, shared_dir(spark, "weekly-versions"))
    table.replace(aggregate.weekly_avg(first.filter(F.year("DATE") <= 1995)))
    table.replace(aggregate.weekly_upsert(table.read(), aggregate.daily_avg(first.filter(F.year("DATE") > 1995))))
    for part, days in enumerate((second.filter(F.month("DATE") <= 6), second.filter(F.month("DATE") > 6))):
        feed, checkpoint = shared_dir(spark, f"feed-{part}"), shared_dir(spark, f"checkpoint-{part}")
        aggregate.daily_avg(days).coalesce(1).write.parquet(feed)
        upsert.weekly_upsert_stream(stream_parquet(spark, feed), table, checkpoint, available_now=True).awaitTermination()
        upsert.upsert_batch(table, stream=checkpoint)(spark.read.parquet(feed), 0)
    return _all_means(table.read())


_CORRECTED = """corrected AS (SELECT city, year, weekofyear, total_cases + CASE WHEN weekofyear % 5 = 0 THEN 7 ELSE 0 END AS total_cases
  FROM cases)"""
_AFTER = ALL.replace("FROM cases WINDOW", "FROM corrected WINDOW").replace(f"{CASES},", f"{CASES}, {_CORRECTED},")


@query(f"""WITH {_AFTER} SELECT city, CAST(year AS INTEGER) AS year, CAST(weekofyear AS INTEGER) AS weekofyear,
    CAST(total_cases AS INTEGER) AS total_cases, {_IS_TEST} AS is_test,
    {", ".join(f'round("{c}", 8) + 0.0 AS "{c}"' for c in FEATURES[2:])} FROM features""")
def training_rows_after_correction(spark, sf_dir):
    """Training rows stored early, then late weather and corrected counts: one row per key, as if
    all had been known at once, each on the side it had."""
    obs, cases = st.observations(spark, sf_dir), _cases(spark, sf_dir)
    store = bootstrap.Store(spark, shared_dir(spark, "store"))
    early = F.col("STATION") % 3 != 0
    store.weekly.replace(aggregate.weekly_avg(obs.filter(early), USED))
    store.put_features(store.feature_rows(cases))
    incremental.merge_daily(store, aggregate.daily_avg(obs.filter(~early), USED), "late", USED)
    late = cases.withColumn("total_cases", (F.col("total_cases") + F.when(F.col("weekofyear") % 5 == 0, 7).otherwise(0)).cast("int"))
    for _ in range(2):
        store.put_features(store.feature_rows(late))
    rows = store.training.read()
    return rows.select(*_week("city"), "total_cases", (F.col("is_test").cast("string") == "true").alias("is_test"),
                       *[(F.round(c, 8) + F.lit(0.0)).alias(c) for c in FEATURES[2:]])
