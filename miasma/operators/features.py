"""Feature rows: case counts joined with weekly weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from miasma.functions.numeric import cos_week, sin_week
from miasma.operators.clean import cast_columns, fill_defaults
from miasma.schema import FEATURES, WEEK_KEY

# Used where several tables carry the region under one name.
REGION = "city"


def add_case_lags(cases: DataFrame, steps: int = 3, key: str = REGION) -> DataFrame:
    """Cases of the last ``steps`` rows of the same region.

    ``cases`` holds one row per region and week, so a region's window is never longer than
    its calendar, however many reports the counts came from.
    """
    history = Window.partitionBy(key).orderBy("year", "weekofyear")
    names = ["lag_cases" if k == 1 else f"lag_cases_{k}" for k in range(1, steps + 1)]
    return cases.withColumns({n: F.lag("total_cases", k).over(history)
                              for k, n in enumerate(names, start=1)})


def week_positions(weeks: DataFrame) -> DataFrame:
    """(year, weekofyear, position): all weeks of the years that occur, numbered without gaps.

    A year has the weeks 1 to 52, and 53 where it occurs. The calendar bounds this table, so
    numbering it in one task is no bottleneck.
    """
    own = weeks.select(F.col("year").cast("int").alias("year"), F.col("weekofyear").cast("int").alias("weekofyear")).dropna().distinct()
    span = own.agg(F.min("year").alias("a"), F.max("year").alias("b")).filter("a IS NOT NULL")
    spine = (span.select(F.explode(F.sequence("a", "b")).alias("year"))
             .select("year", F.explode(F.sequence(F.lit(1), F.lit(52))).alias("weekofyear")))
    return (spine.unionByName(own).distinct()
            .withColumn("position", F.row_number().over(Window.orderBy("year", "weekofyear"))))


def add_case_lags_by_week(cases: DataFrame, steps: int = 3, key: str = REGION) -> DataFrame:
    """Cases 1 … ``steps`` weeks before in the same region, null where that week has no count.

    ``add_case_lags`` counts a region's rows instead, as models of older rows expect; here a missing
    week does not move the ones before it nearer. A week is found by its number in the calendar of
    the whole table.
    """
    types = dict(cases.dtypes)
    positions = week_positions(cases).withColumns({c: F.col(c).cast(types[c]) for c in ("year", "weekofyear")})
    placed = cases.join(positions, ["year", "weekofyear"])
    region = Window.partitionBy(key).orderBy("position")
    names = ["lag_cases" if k == 1 else f"lag_cases_{k}" for k in range(1, steps + 1)]
    return placed.withColumns({n: F.max("total_cases").over(region.rangeBetween(-k, -k))
                               for k, n in enumerate(names, start=1)}).select(*cases.columns, *names)


def add_seasonal(df: DataFrame, week: str = "weekofyear") -> DataFrame:
    return df.withColumns({"sin_week": sin_week(F.col(week)), "cos_week": cos_week(F.col(week))})


def add_interaction(df: DataFrame) -> DataFrame:
    return df.withColumn("temp_prcp_interaction", F.col("avg_TEMP") * F.col("avg_PRCP"))


def join_weather(cases: DataFrame, weekly: DataFrame, how: str = "inner",
                 regional: bool = False) -> DataFrame:
    """Case rows with the weather of their week; with ``regional`` of their region as well.

    Weather keys are renamed to the case keys, so the join leaves no second copy.
    ``how="left"`` adds ``has_weather``.
    """
    on = [REGION] * regional + ["year", "weekofyear"]
    weather = weekly.withColumnsRenamed(dict(zip(WEEK_KEY, ["year", "weekofyear"])))
    weather = weather.select(*on, *[c for c in weekly.columns if c.startswith("avg_")])
    if how == "left":
        weather = weather.withColumn("has_weather", F.lit(True))
        joined = cases.join(weather, on, "left")
        return joined.withColumn("has_weather", F.coalesce("has_weather", F.lit(False)))
    return cases.join(weather, on, how)


def finish_features(df: DataFrame) -> DataFrame:
    """Interaction term, double inputs, nulls to 0."""
    return fill_defaults(cast_columns(add_interaction(df), FEATURES), FEATURES)


def feature_rows(cases: DataFrame, weekly: DataFrame, how: str = "inner",
                 regional: bool = False) -> DataFrame:
    """Model-ready rows for all weeks that have both cases and weather."""
    enriched = add_seasonal(add_case_lags(cases))
    return finish_features(join_weather(enriched, weekly, how, regional))


def forecast_features(weekly: DataFrame, lags: DataFrame | None = None,
                      keys=()) -> DataFrame:
    """Feature rows for weeks without cases.

    Lags are 0 unless ``lags`` brings the last known counts: one row per region (see
    ``last_known_lags``) or one per region and week (see ``as_of_lags``).
    """
    base = weekly.withColumnsRenamed(dict(zip(WEEK_KEY, ["year", "weekofyear"])))
    base = add_seasonal(base.select(
        *keys, "year", "weekofyear", *[c for c in weekly.columns if c.startswith("avg_")]))
    names = ["lag_cases", "lag_cases_2", "lag_cases_3"]
    if lags is None:
        base = base.withColumns({n: F.lit(0.0) for n in names})
    else:
        on = [*keys, *[c for c in ("year", "weekofyear") if c in lags.columns]]
        base = base.join(lags.select(*on, *names), on, "left")
    return finish_features(base)


def as_of_lags(weeks: DataFrame, cases: DataFrame, keys=(REGION,)) -> DataFrame:
    """The (keys, year, weekofyear) of ``weeks`` with the last three counts before each.

    Case rows and wanted weeks lie in one window per region, so a gap week sees the counts before
    it and none of those after it. A region has one row per week at most.
    """
    names = ["lag_cases", "lag_cases_2", "lag_cases_3"]
    on = [*keys, "year", "weekofyear"]
    past = Window.partitionBy(*keys).orderBy("year", "weekofyear")
    known = cases.select(*on, F.col("total_cases").cast("double").alias("last"),
                         *[F.lag("total_cases", k).over(past).cast("double").alias(f"last_{k + 1}") for k in (1, 2)])
    known = known.select(*on, F.struct("last", "last_2", "last_3").alias("counts"), F.lit(False).alias("wanted"))
    wanted = weeks.select(*[F.col(c).cast(cases.schema[c].dataType).alias(c) for c in on],
                          F.lit(None).cast(known.schema["counts"].dataType).alias("counts"), F.lit(True).alias("wanted"))
    before = past.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last("counts", ignorenulls=True).over(before)
    return (known.unionByName(wanted).withColumn("counts", seen).filter("wanted")
            .select(*on, *[F.col(f"counts.{c}").alias(n) for c, n in zip(("last", "last_2", "last_3"), names)]))


def forecast_steps(weeks: DataFrame, cases: DataFrame, keys=(REGION,)) -> DataFrame:
    """The (keys, year, weekofyear) of ``weeks`` in the order in which a recursive forecast takes them.

    ``step`` numbers a region's weeks from 1. ``known`` holds the up to three newest counts that lie
    between a week and the forecast week before it, newest first, as structs (value, scored): a step
    sees these, then what the steps before it left. Each region and week occurs once at most.
    """
    on = [*keys, "year", "weekofyear"]
    wanted = weeks.select(*[F.col(c).cast(cases.schema[c].dataType).alias(c) for c in on],
                          F.lit(None).cast("double").alias("value"), F.lit(True).alias("wanted"))
    known = cases.select(*on, F.col("total_cases").cast("double").alias("value"), F.lit(False).alias("wanted"))
    in_order = Window.partitionBy(*keys).orderBy("year", "weekofyear")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    both = known.unionByName(wanted).withColumn("step", F.coalesce(F.count_if("wanted").over(before), F.lit(0)) + 1)
    newest = Window.partitionBy(*keys, "step").orderBy(F.desc("year"), F.desc("weekofyear"))
    recent = (both.filter("NOT wanted").withColumn("back", F.row_number().over(newest)).filter("back <= 3")
              .groupBy(*keys, "step").agg(F.sort_array(F.collect_list(F.struct("back", "value"))).alias("counts")))
    as_known = F.transform("counts", lambda c: F.struct(c["value"].alias("value"), F.lit(False).alias("scored")))
    return (both.filter("wanted").select(*on, "step").join(recent, [*keys, "step"], "left")
            .select(*on, "step", F.coalesce(as_known, F.array().cast("array<struct<value:double,scored:boolean>>")).alias("known")))


def last_known_lags(cases: DataFrame, key: str = REGION) -> DataFrame:
    """Per region its three latest counts, as the lags of the first week to come."""
    latest = Window.partitionBy(key).orderBy(F.desc("year"), F.desc("weekofyear"))
    back = F.row_number().over(latest)
    recent = cases.withColumn("back", back).filter(F.col("back") <= 3)
    pick = lambda k: F.max(F.when(F.col("back") == k, F.col("total_cases"))).cast("double")
    return recent.groupBy(key).agg(
        pick(1).alias("lag_cases"), pick(2).alias("lag_cases_2"), pick(3).alias("lag_cases_3"))
