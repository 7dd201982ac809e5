"""Later loads: merge new daily means, retrain on new weeks, forecast weeks without cases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.operators.aggregate import empty_weekly, weekly_upsert
from miasma.operators.features import as_of_lags, forecast_features, forecast_steps
from miasma.operators.geo import add_neighbour_lags
from miasma.operators.keys import restrict_to_weeks, unmatched_weeks
from miasma.operators.model import prediction_table, score
from miasma.plans.bootstrap import Store
from miasma.schema import MEASURES
from miasma.session import shared_dir, written
from miasma.sinks.tables import new_attempt
from miasma.sources.files import (list_files, new_files, read_files, read_table, rows_of_files,
                                  years_of_files)

MAX_NAMED_FILES = 10_000


def merge_daily(store: Store, daily: DataFrame, delivery: str, measures=MEASURES) -> int | None:
    """Merge daily means that carry a delivery's name; returns the version.

    The name is committed with the version, so the same delivery counts once, however often it
    comes.
    """
    table, stream = store.weekly, f"delivery:{delivery}"
    if table.log.holds(stream, 0):
        return None
    return table.replace(weekly_upsert(table.read(), daily, table.keys, measures), stream, 0)


def rows_of_new_files(spark: SparkSession, daily_root: str, fresh: DataFrame) -> DataFrame:
    """Rows of the listed files of a daily table. Usually the files of a delivery are named and only
    they are read. A first load may have too many to name: then the years they lie in are read and
    joined with the list; the rows are the same."""
    paths = [r.path for r in fresh.select("path").limit(MAX_NAMED_FILES + 1).collect()]
    if len(paths) <= MAX_NAMED_FILES:
        return read_files(spark, daily_root, paths)
    # A handful of years at most; as literals they prune the scan to the folders that changed.
    years = [r.year for r in years_of_files(fresh).collect()]
    return rows_of_files(read_table(spark, daily_root).filter(F.col("Weather_Year").isin(years)), fresh)


def merge_new_files(store: Store, daily_root: str, measures=MEASURES) -> int | None:
    """Merge the files of a daily table that no earlier run has merged; returns the version.

    The list of merged files is written before the version it belongs to is committed, in a folder
    of the same attempt, and only lists of committed attempts count. A run that dies in between
    is simply repeated, so a file is merged exactly once; of two runs at a time one fails.
    """
    spark, table = store.spark, store.weekly
    fresh = new_files(list_files(spark, daily_root), store.merged_files())
    if fresh.isEmpty():
        return None
    last, attempt = table.log.latest(), new_attempt()
    ledger = f"{store.ledger_path}/attempt={attempt}"
    fresh.select("path").write.parquet(ledger)
    incoming = rows_of_new_files(spark, daily_root, spark.read.parquet(ledger))
    existing = empty_weekly(spark, measures, table.keys) if last is None else table.read(last)
    version = 0 if last is None else last + 1
    table.write(weekly_upsert(existing, incoming, table.keys, measures), version, attempt)
    return version


def retrain(store: Store, cases: DataFrame, **forest_size):
    """Bring the training rows up to date, then train one model on all of them.

    All weeks with weather and cases are worked out again from the stored weekly means, which the
    calendar bounds, and replace the rows of their keys: late readings and corrected counts reach
    stored rows. The split by key keeps test weeks out of the training rows for ever.
    """
    store.put_features(store.feature_rows(cases))
    return store.train(**forest_size)


def forecast_rows(store: Store, cases: DataFrame) -> DataFrame:
    """Feature rows of every weather week that no case row covers.

    In a regional store a region's weeks are compared with its own cases, and its last counts
    before each week serve as lags. A store without regions takes the cases of one place.
    """
    weekly, keys = store.weekly.read(), store.keys
    weeks = unmatched_weeks(weekly, cases, keys)
    wanted = restrict_to_weeks(weekly, weeks, keys)
    rows = forecast_features(wanted, as_of_lags(weeks, cases, keys) if keys else None, keys)
    return rows if store.near is None else add_neighbour_lags(rows, cases, store.near)


def forecast(store: Store, cases: DataFrame) -> DataFrame:
    """Predict the weeks of ``forecast_rows``; stored and returned."""
    rows, keys = forecast_rows(store, cases), store.keys
    store.predictions.replace(prediction_table(score(store.model(), rows, store.inputs), keys))
    return store.predictions.read()


def recursive_forecast(store: Store, cases: DataFrame, score_rows: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Predict the weeks of ``forecast_rows`` one after the other: a region's forecast is a lag of its
    weeks to come. Returns the feature rows with ``prediction`` and ``scored_lags``, which tells of
    each lag whether it is a forecast.

    Step s works on the s-th such week of every region at once and is stored with each region's last
    three values, the state of the next step; counts that lie between two forecast weeks come first.
    There are as many steps as weeks to forecast in the region with most of them.
    ``score_rows`` adds ``prediction``; the stored model does it by default. Neighbours' counts stay
    those that are known.
    """
    if not store.keys:
        raise ValueError("a recursive forecast needs a regional store")
    spark, keys = store.spark, list(store.keys)
    scoring = score_rows or (lambda rows, model=store.model(): score(model, rows, store.inputs))
    names = ["lag_cases", "lag_cases_2", "lag_cases_3"]
    weeks = unmatched_weeks(store.weekly.read(), cases, keys)
    plan = forecast_steps(weeks, cases, keys)
    rows = forecast_features(restrict_to_weeks(store.weekly.read(), weeks, keys), None, keys).drop(*names)
    if store.near is not None:
        rows = add_neighbour_lags(rows, cases, store.near)
    # The keys of feature rows are doubles.
    plan = plan.withColumns({c: F.col(c).cast("double") for c in ("year", "weekofyear")})
    rows = written(spark, rows.join(plan, [*keys, "year", "weekofyear"]), "recursive-rows")
    steps = rows.agg(F.max("step")).first()[0] or 0
    state = spark.createDataFrame([], rows.select(*keys, F.col("known").alias("last")).schema)
    done: list[str] = []
    for step in range(1, steps + 1):
        now = rows.filter(F.col("step") == step).join(state, keys, "left")
        last = F.slice(F.concat("known", F.coalesce("last", F.array().cast(rows.schema["known"].dataType))), 1, 3)
        now = now.withColumn("last", last).withColumns({
            **{n: F.coalesce(F.get("last", i)["value"], F.lit(0.0)) for i, n in enumerate(names)},
            "scored_lags": F.transform("last", lambda v: v["scored"])})
        path = shared_dir(spark, f"recursive-step-{step}")
        scoring(now.drop("known", "step")).write.parquet(path)
        done.append(path)
        # A region that has a step has all before it, so the step just written is all that the next one needs.
        value = F.struct(F.col("prediction").alias("value"), F.lit(True).alias("scored"))
        state = spark.read.parquet(path).select(*keys, F.slice(F.concat(F.array(value), "last"), 1, 3).alias("last"))
    if not done:
        return scoring(rows.withColumns({**{n: F.lit(0.0) for n in names}, "scored_lags": F.array().cast("array<boolean>")})
                       .drop("known", "step"))
    return spark.read.parquet(*done).drop("last")
