"""Queries on calendar terms, means, features, week keys, metrics, points and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from miasma.functions import calendar, numeric
from miasma.operators import aggregate, features, keys, metrics, model, points, regional
from miasma.operators.clean import dedupe_observations
from miasma.plans import standins as st
from miasma.plans.registry import query
from miasma.schema import CASE_KEY, FEATURES, MEASURES, WEEK_KEY, sum_columns
from miasma.session import shared_dir
from miasma.sinks import tables
from miasma.sinks.published import PublishedLines
from miasma.streaming.sources import stream_parquet

OBS, CASES, WEEKLY = st.SQL_OBS, st.SQL_CASES, st.SQL_WEEKLY
LAGGED, FEATURE_ROWS = st.SQL_LAGGED, st.SQL_FEATURES
ALL = f"{OBS}, {WEEKLY}, {CASES}, {LAGGED}, {FEATURE_ROWS}"
USED = ["TEMP", "PRCP", "DEWP"]


def _digits(columns: dict[str, int]) -> str:
    """Rounded SQL columns; adding 0.0 turns a negative zero into zero, as in ``_rounded``."""
    return ", ".join(f'round({c}, {d}) + 0.0 AS {c}' for c, d in columns.items())


def _rounded(df, columns: dict[str, int]):
    return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in columns.items()})


def _weekly(spark, sf_dir, measures=USED):
    return aggregate.weekly_avg(st.observations(spark, sf_dir), measures)


def _feature_rows(spark, sf_dir):
    return features.feature_rows(st.weekly_cases(spark, sf_dir), _weekly(spark, sf_dir))


# ---- calendar and scale ----

@query("""SELECT CAST(l_shipdate AS DATE)::VARCHAR AS day, CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(week(l_shipdate) AS INTEGER) AS week, CAST(isoyear(l_shipdate) AS INTEGER) AS iso_year,
    CAST(date_trunc('week', l_shipdate) AS DATE)::VARCHAR AS monday, count(*) AS n
  FROM lineitem GROUP BY l_shipdate""")
def calendar_features(spark, sf_dir):
    """Calendar year, ISO week, ISO year and Monday of each day."""
    day = F.col("DATE")
    days = st.observations(spark, sf_dir).groupBy("DATE").agg(F.count("*").alias("n"))
    return calendar.with_week_key(days).select(
        day.cast("string").alias("day"), F.col("Weather_Year").alias("year"),
        F.col("Weather_Week").alias("week"), calendar.week_year(day, iso=True).alias("iso_year"),
        calendar.iso_week_monday(day).cast("string").alias("monday"), "n")


@query(f"""WITH {CASES} SELECT DISTINCT year, weekofyear,
    (make_date(year, 1, 1) + (weekofyear - 1) * 7)::DATE::VARCHAR AS week_start FROM cases""")
def week_start_date(spark, sf_dir):
    weeks = keys.distinct_weeks(st.weekly_cases(spark, sf_dir))
    start = calendar.week_start_date(F.col("year"), F.col("weekofyear"))
    return weeks.withColumn("week_start", start.cast("string"))


@query(f"""WITH {CASES} SELECT DISTINCT weekofyear, round(sin(2 * pi() * weekofyear / 52), 9) + 0.0 AS sin_week,
    round(cos(2 * pi() * weekofyear / 52), 9) + 0.0 AS cos_week FROM cases""")
def seasonal_features(spark, sf_dir):
    weeks = st.weekly_cases(spark, sf_dir).select("weekofyear").distinct()
    return _rounded(features.add_seasonal(weeks), {"sin_week": 9, "cos_week": 9})


@query(f"""WITH {CASES} SELECT city, year, weekofyear, total_cases,
    round(ln(1 + total_cases), 9) AS log_total_cases,
    round(exp(ln(1 + total_cases)) - 1, 4) + 0.0 AS restored FROM cases""")
def log_transform(spark, sf_dir):
    """Cases on the log scale and back."""
    logged = model.with_label(st.weekly_cases(spark, sf_dir))
    back = logged.withColumn("restored", numeric.from_log(F.col("log_total_cases")))
    return _rounded(back, {"log_total_cases": 9, "restored": 4})


# ---- means ----

@query(f'WITH {OBS}, {WEEKLY} SELECT * FROM weekly')
def weekly_avg(spark, sf_dir):
    """All 16 means per week."""
    weekly = _weekly(spark, sf_dir, MEASURES)
    return weekly.drop(*sum_columns(MEASURES))


_DAILY = f"""SELECT "Weather_Year", "Weather_Week", CAST("DATE" AS VARCHAR) AS "DATE",
    count(*) AS record_count, {st.sql_avgs()} FROM obs GROUP BY "Weather_Year", "Weather_Week", obs."DATE" """


@query(f"WITH {OBS} {_DAILY}")
def daily_avg_count(spark, sf_dir):
    """All 16 means and the row count per day."""
    daily = aggregate.daily_avg(st.observations(spark, sf_dir))
    return daily.select(*WEEK_KEY, F.col("DATE").cast("string").alias("DATE"), "record_count",
                        *[f"avg_{m}" for m in MEASURES])


@query(f"""WITH {OBS} SELECT "Weather_Year", "Weather_Week", count(*) AS record_count,
    {", ".join(f'round(avg("{m}"), 8) AS "avg_{m}", count("{m}") AS "n_{m}"' for m in USED)}
  FROM obs GROUP BY "Weather_Year", "Weather_Week" """)
def weighted_merge(spark, sf_dir):
    """Weekly means made from daily means, equal to the means of all readings."""
    daily = aggregate.daily_avg(st.observations(spark, sf_dir), USED)
    merged = aggregate.weighted_merge(daily, measures=USED).drop(*sum_columns(USED))
    return _rounded(merged, {f"avg_{m}": 8 for m in USED})


# ---- features ----

@query(f"""WITH {CASES}, {LAGGED} SELECT city, year, weekofyear, total_cases, lag_cases::DOUBLE AS lag_cases,
    lag_cases_2::DOUBLE AS lag_cases_2, lag_cases_3::DOUBLE AS lag_cases_3 FROM lagged""")
def case_lags(spark, sf_dir):
    """Cases with those of the three weeks before."""
    lagged = features.add_case_lags(st.weekly_cases(spark, sf_dir))
    return lagged.withColumns({c: F.col(c).cast("double")
                               for c in ("lag_cases", "lag_cases_2", "lag_cases_3")})


_FEATURE_SQL = ", ".join(
    f"round({c}, 9) + 0.0 AS {c}" if c in ("sin_week", "cos_week") else f'"{c}"' for c in FEATURES)


@query(f"WITH {ALL} SELECT city, total_cases, {_FEATURE_SQL} FROM features")
def feature_join_inner(spark, sf_dir):
    """Model-ready rows: cases, weather of the week, lags, season and interaction."""
    rows = _feature_rows(spark, sf_dir).select("city", "total_cases", *FEATURES)
    return _rounded(rows, {"sin_week": 9, "cos_week": 9})


_LEFT = f"""joined AS (SELECT city, CAST(year AS DOUBLE) AS year, CAST(weekofyear AS DOUBLE) AS weekofyear,
    total_cases, coalesce("avg_TEMP", 0) AS "avg_TEMP", coalesce("avg_PRCP", 0) AS "avg_PRCP",
    record_count IS NOT NULL AS has_weather
  FROM cases LEFT JOIN weekly ON year = "Weather_Year" AND weekofyear = "Weather_Week")"""
_LEFT_ALL = f"{OBS}, {WEEKLY}, {CASES}, {_LEFT}"


def _left(spark, sf_dir):
    return features.feature_rows(st.weekly_cases(spark, sf_dir), _weekly(spark, sf_dir), how="left")


@query(f"WITH {_LEFT_ALL} SELECT * FROM joined")
def feature_join_left(spark, sf_dir):
    """All case weeks, with the weather of those that have any."""
    return _left(spark, sf_dir).select(
        "city", "year", "weekofyear", "total_cases", "avg_TEMP", "avg_PRCP", "has_weather")


@query(f"""WITH {OBS}, {CASES}, place AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS "STATION", r_name AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  weeks AS (SELECT city, "Weather_Year" AS year, "Weather_Week" AS weekofyear, count(*) AS record_count
    FROM obs JOIN place USING ("STATION") GROUP BY ALL)
  SELECT city, CASE WHEN total_cases IS NULL THEN 'unmatched' ELSE 'matched' END AS side, count(*) AS n,
    CAST(sum(record_count) AS BIGINT) AS record_count
  FROM weeks LEFT JOIN cases USING (city, year, weekofyear) GROUP BY ALL""")
def matched_unmatched_split(spark, sf_dir):
    """Weather weeks with and without cases, counted per region: a natural gap."""
    weekly = regional.regional_weekly(st.observations(spark, sf_dir), st.station_regions(spark, sf_dir), ["TEMP"])
    weeks = weekly.withColumnsRenamed(dict(zip(WEEK_KEY, ["year", "weekofyear"])))
    known = st.weekly_cases(spark, sf_dir).select(*CASE_KEY, F.lit(True).alias("known"))
    side = F.when(F.col("known"), "matched").otherwise("unmatched")
    return (weeks.join(known, CASE_KEY, "left").groupBy("city", side.alias("side"))
            .agg(F.count("*").alias("n"), F.sum("record_count").alias("record_count")))


_UNMATCHED = """unmatched AS (SELECT DISTINCT "Weather_Year" AS year, "Weather_Week" AS weekofyear
  FROM weekly WHERE NOT EXISTS (SELECT 1 FROM cases WHERE year = "Weather_Year" AND weekofyear = "Weather_Week"))"""


@query(f"WITH {OBS}, {WEEKLY}, {CASES}, {_UNMATCHED} SELECT * FROM unmatched")
def unmatched_weeks(spark, sf_dir):
    """Weather weeks without cases."""
    return keys.unmatched_weeks(_weekly(spark, sf_dir), st.weekly_cases(spark, sf_dir))


@query(f"""WITH {OBS}, {WEEKLY}, {CASES}, {_UNMATCHED}
  SELECT "Weather_Year", "Weather_Week", record_count, "avg_TEMP", "avg_PRCP", "avg_DEWP"
  FROM weekly SEMI JOIN unmatched ON year = "Weather_Year" AND weekofyear = "Weather_Week" """)
def forecast_key_semi(spark, sf_dir):
    """The weather of the weeks to forecast."""
    weekly = st.stored(spark, _weekly(spark, sf_dir), "weekly")
    weeks = keys.unmatched_weeks(weekly, st.weekly_cases(spark, sf_dir))
    return keys.restrict_to_weeks(weekly, weeks).select(
        *WEEK_KEY, "record_count", *[f"avg_{m}" for m in USED])


@query(f"""WITH {OBS}, {WEEKLY} SELECT CAST("Weather_Year" AS DOUBLE) AS year,
    CAST("Weather_Week" AS DOUBLE) AS weekofyear, coalesce("avg_TEMP", 0) AS "avg_TEMP",
    coalesce("avg_PRCP", 0) AS "avg_PRCP", coalesce("avg_DEWP", 0) AS "avg_DEWP",
    CAST(0 AS DOUBLE) AS lag_cases, CAST(0 AS DOUBLE) AS lag_cases_2, CAST(0 AS DOUBLE) AS lag_cases_3,
    round(sin(2 * pi() * "Weather_Week" / 52), 9) + 0.0 AS sin_week,
    round(cos(2 * pi() * "Weather_Week" / 52), 9) + 0.0 AS cos_week,
    coalesce("avg_TEMP" * "avg_PRCP", 0) AS temp_prcp_interaction FROM weekly""")
def forecast_features(spark, sf_dir):
    """Feature rows for weeks whose cases are unknown."""
    rows = features.forecast_features(_weekly(spark, sf_dir)).select(*FEATURES)
    return _rounded(rows, {"sin_week": 9, "cos_week": 9})


@query(f"""WITH {OBS}, {WEEKLY}, {CASES} SELECT "Weather_Year" AS year, "Weather_Week" AS weekofyear
  FROM weekly WHERE "Weather_Year" * 100 + "Weather_Week" > (SELECT max(year * 100 + weekofyear) FROM cases)""")
def after_latest_key(spark, sf_dir):
    """Weather weeks later than the last week with cases."""
    weeks = keys.weather_weeks(_weekly(spark, sf_dir))
    return keys.after_latest_key(weeks, st.weekly_cases(spark, sf_dir))


@query(f"""WITH {OBS} SELECT DISTINCT "Weather_Year" AS year, "Weather_Week" AS weekofyear FROM obs""")
def distinct_weeks(spark, sf_dir):
    return keys.weather_weeks(calendar.with_week_key(st.observations(spark, sf_dir)))


@query(f"""WITH {ALL} SELECT city, total_cases, {", ".join(
    f'round({c}, 9) + 0.0 AS f{i}' if c in ("sin_week", "cos_week") else f'"{c}" AS f{i}'
    for i, c in enumerate(FEATURES))} FROM features""")
def feature_array(spark, sf_dir):
    """The assembled vector, taken apart again."""
    rows = model.feature_array(model.assemble(_feature_rows(spark, sf_dir)))
    parts = rows.select("city", "total_cases",
                        *[F.col("feature_array")[i].alias(f"f{i}") for i in range(len(FEATURES))])
    season = [f"f{FEATURES.index(c)}" for c in ("sin_week", "cos_week")]
    return _rounded(parts, {c: 9 for c in season})


@query(f"SELECT CAST({len(FEATURES)} AS INTEGER) AS length FROM lineitem LIMIT 1")
def feature_length_check(spark, sf_dir):
    """All vectors have one length."""
    return model.feature_lengths(model.assemble(_feature_rows(spark, sf_dir)))


@query(f"""WITH {CASES} SELECT city, year, weekofyear,
    ('0x' || substr(md5('1947|' || city || '|' || year || '|' || weekofyear), 1, 8))::BIGINT % 100 < 20 AS is_test
  FROM cases""")
def hash_split(spark, sf_dir):
    """Training and test side of every case week."""
    return model.hash_split(st.weekly_cases(spark, sf_dir)).drop("total_cases")


@query(f"""WITH {ALL} SELECT city, CAST(year AS INTEGER) AS year, count(*) AS n,
    CAST(sum(total_cases) AS BIGINT) AS total_cases FROM features GROUP BY ALL""")
def append_new_training_rows(spark, sf_dir):
    """A training table of the early years, then twice extended by all rows: none is doubled."""
    path = shared_dir(spark, "training")
    rows = st.stored(spark, _feature_rows(spark, sf_dir), "features")
    rows.filter("year <= 1998").write.parquet(path)
    for _ in range(2):
        tables.append_new(rows, path, CASE_KEY)
    return (spark.read.parquet(path).groupBy("city", F.col("year").cast("int").alias("year"))
            .agg(F.count("*").alias("n"), F.sum("total_cases").alias("total_cases")))


# ---- quality and points ----

_NAIVE = """naive AS (SELECT city, year, weekofyear, total_cases,
    lag(total_cases) OVER (PARTITION BY city ORDER BY year, weekofyear)::DOUBLE AS prediction
  FROM cases QUALIFY prediction IS NOT NULL)"""


def _naive(spark, sf_dir):
    """Last week's count as forecast."""
    lagged = features.add_case_lags(st.weekly_cases(spark, sf_dir), steps=1)
    return (lagged.withColumn("prediction", F.col("lag_cases").cast("double"))
            .drop("lag_cases").dropna(subset=["prediction"]))


_METRICS = {"r2": 6, "rmse": 6, "mae": 6, "mape": 6, "accuracy": 6}
_METRICS_SQL = """SELECT city, count(*) AS n,
    round(1 - sum(power(total_cases - prediction, 2))
      / nullif(sum(power(total_cases, 2)) - power(sum(total_cases), 2) / count(*), 0), 6) AS r2,
    round(sqrt(avg(power(total_cases - prediction, 2))), 6) AS rmse,
    round(avg(abs(total_cases - prediction)), 6) AS mae,
    round(100 * avg(abs((total_cases - prediction) / nullif(total_cases, 0))), 6) AS mape,
    round(100 - 100 * avg(abs((total_cases - prediction) / nullif(total_cases, 0))), 6) AS accuracy"""


@query(f"""WITH {CASES}, {_NAIVE} {_METRICS_SQL} FROM naive GROUP BY city
  UNION ALL {_METRICS_SQL.replace("SELECT city", "SELECT 'all' AS city")} FROM naive""")
def regression_metrics(spark, sf_dir):
    """Quality of the naive forecast per region and overall."""
    quality = metrics.regression_metrics(_naive(spark, sf_dir), keys=("city",), overall=True)
    return _rounded(quality.fillna("all", ["city"]), _METRICS)


_POINTS = f"""WITH {CASES}, {_NAIVE} SELECT 'predicted_cases,region=' || replace(city, ' ', '\\ ') || ',year=' || year
    || ' weekofyear=' || weekofyear || 'i,predicted_cases=' || prediction || ' '
    || (epoch_us((make_date(year, 1, 1) + (weekofyear - 1) * 7)::TIMESTAMP) * 1000)::BIGINT AS line FROM naive"""


@query(_POINTS)
def prediction_points(spark, sf_dir):
    """Naive forecasts as time-series points."""
    return points.prediction_points(_naive(spark, sf_dir), region="city")


@query(_POINTS)
def points_written(spark, sf_dir):
    """The same points written with a commit, a stream of them published twice over, and read back."""
    spark.dataSource.register(PublishedLines)
    path, feed = shared_dir(spark, "points"), shared_dir(spark, "points-feed")
    lines = st.stored(spark, points.prediction_points(_naive(spark, sf_dir), region="city"), "lines")
    early = F.col("line").rlike("weekofyear=[1-9]i")
    lines.filter(early).write.format("published_lines").mode("append").save(path)
    lines.filter(~early).write.parquet(feed)
    for run in range(2):  # the second checkpoint repeats the batches of the first
        (stream_parquet(spark, feed).writeStream.format("published_lines").trigger(availableNow=True)
         .option("checkpointLocation", f"{path}-checkpoint-{run}").start(path).awaitTermination())
    return spark.read.format("published_lines").load(path)


@query(f"""WITH {CASES}, {_NAIVE}, m AS ({_METRICS_SQL} FROM naive GROUP BY city)
  SELECT city, 'model_accuracy,region=' || replace(city, ' ', '\\ ') || ' accuracy=' || printf('%.4f', accuracy) || ',mape=' || printf('%.4f', mape)
    || ' 1700000000000000000' AS line, printf('%.2f', mape) || '%' AS mape_text FROM m""")
def accuracy_points(spark, sf_dir):
    """Quality per region as points at a given run time, and as reported text."""
    scored = metrics.regression_metrics(_naive(spark, sf_dir), keys=("city",))
    fixed = _rounded(scored, _METRICS)
    text = fixed.withColumn("mape_text", points.percent_text(F.col("mape")))
    return points.accuracy_points(text, 1_700_000_000_000_000_000, keep=("city", "mape_text"), digits=4,
                                  region="city")


# ---- regions ----

_RISK = {"mean_cases": 6, "sd_cases": 6, "risk": 6}


@query(f"""WITH {CASES}, {_NAIVE}, stats AS (SELECT city, max(year * 100 + weekofyear) AS latest,
    avg(total_cases) AS mean_cases, stddev_samp(total_cases) AS sd_cases FROM naive GROUP BY city)
  SELECT city, year, weekofyear, prediction AS expected_cases, round(mean_cases, 6) AS mean_cases,
    round(sd_cases, 6) AS sd_cases, round(prediction / mean_cases, 6) AS risk
  FROM naive JOIN stats USING (city) WHERE year * 100 + weekofyear = latest""")
def regional_risk(spark, sf_dir):
    """Newest forecast of each region against its mean week."""
    return _rounded(regional.regional_risk(_naive(spark, sf_dir)), _RISK)


@query(f"""WITH {OBS}, place AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS "STATION", r_name AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  SELECT city, "Weather_Year", "Weather_Week", count(*) AS record_count,
    {", ".join(f'round(avg("{m}"), 8) AS "avg_{m}"' for m in USED)}
  FROM obs JOIN place USING ("STATION") GROUP BY city, "Weather_Year", "Weather_Week" """)
def regional_weekly(spark, sf_dir):
    """Weekly means per region."""
    weekly = regional.regional_weekly(st.observations(spark, sf_dir),
                                      st.station_regions(spark, sf_dir), USED)
    return _rounded(weekly.select("city", *WEEK_KEY, "record_count", *[f"avg_{m}" for m in USED]),
                    {f"avg_{m}": 8 for m in USED})


@query(f"""WITH {OBS}, {CASES}, place AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS "STATION", r_name AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  weeks AS (SELECT DISTINCT city, "Weather_Year" AS year, "Weather_Week" AS weekofyear
    FROM obs JOIN place USING ("STATION"))
  SELECT * FROM weeks ANTI JOIN cases USING (city, year, weekofyear)""")
def regional_unmatched_weeks(spark, sf_dir):
    """Weeks to forecast, region by region."""
    weekly = regional.regional_weekly(st.observations(spark, sf_dir),
                                      st.station_regions(spark, sf_dir), ["TEMP"])
    return keys.unmatched_weeks(weekly, st.weekly_cases(spark, sf_dir), ("city",))


SCENARIOS = [
    regional.Scenario("as is"),
    regional.Scenario("warmer", temp_delta=2.0),
    regional.Scenario("wetter", prcp_factor=1.5),
    regional.Scenario("spreading", temp_delta=1.0, case_factor=2.0),
]


@query(f"""WITH {ALL}, scenarios(scenario, delta, prcp, spread) AS (VALUES {", ".join(
    f"('{s.name}', CAST({s.temp_delta} AS DOUBLE), CAST({s.prcp_factor} AS DOUBLE), CAST({s.case_factor} AS DOUBLE))"
    for s in SCENARIOS)})
  SELECT city, year, weekofyear, scenario, "avg_TEMP" + delta AS "avg_TEMP", "avg_PRCP" * prcp AS "avg_PRCP",
    lag_cases * spread AS lag_cases, ("avg_TEMP" + delta) * ("avg_PRCP" * prcp) AS temp_prcp_interaction
  FROM features, scenarios""")
def scenario_grid(spark, sf_dir):
    """Feature rows under four changes of weather and cases."""
    grid = regional.scenario_grid(_feature_rows(spark, sf_dir), SCENARIOS)
    return grid.select("city", "year", "weekofyear", "scenario", "avg_TEMP", "avg_PRCP",
                       "lag_cases", "temp_prcp_interaction")


@query(f"""WITH {CASES}, level AS (SELECT city, avg(total_cases) + stddev_samp(total_cases) AS threshold
    FROM cases GROUP BY city)
  SELECT city, year, weekofyear, total_cases, round(threshold, 6) AS threshold,
    CAST(total_cases > threshold AS INTEGER) AS outbreak FROM cases JOIN level USING (city)""")
def outbreak_flag(spark, sf_dir):
    """Weeks well above their region's mean."""
    return _rounded(regional.outbreak_flag(st.weekly_cases(spark, sf_dir)), {"threshold": 6})


@query(f"""WITH {CASES} SELECT now.*, ago.total_cases::DOUBLE AS prediction FROM cases now LEFT JOIN cases ago
    ON ago.city = now.city AND ago.year = now.year - 1 AND ago.weekofyear = now.weekofyear""")
def seasonal_naive(spark, sf_dir):
    """The count of the same week a year before as forecast."""
    return regional.seasonal_naive(st.weekly_cases(spark, sf_dir))


@query(f"""WITH {CASES}, t AS (SELECT city,
    (make_date(year, 1, 1) + (weekofyear - 1) * 7 - DATE '1970-01-01') / 7.0::DOUBLE AS t, total_cases::DOUBLE AS y FROM cases),
  fit AS (SELECT city, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, max(t) AS last_t FROM t GROUP BY city)
  SELECT city, round(slope, 8) + 0.0 AS slope, round(intercept, 4) + 0.0 AS intercept,
    round(intercept + slope * (last_t + 4), 6) + 0.0 AS forecast FROM fit""")
def trend_forecast(spark, sf_dir):
    """Linear trend of each region and its value four weeks ahead."""
    fitted = regional.trend_forecast(st.weekly_cases(spark, sf_dir))
    return _rounded(fitted, {"slope": 8, "intercept": 4, "forecast": 6})


@query(f"""WITH {OBS}, d AS (SELECT "Weather_Year", "Weather_Week", min("TEMP") AS "TEMP", min("PRCP") AS "PRCP"
    FROM obs GROUP BY "STATION", obs."DATE", "Weather_Year", "Weather_Week")
  SELECT "Weather_Year", "Weather_Week", count(*) AS record_count, avg("TEMP") AS "avg_TEMP", avg("PRCP") AS "avg_PRCP"
  FROM d GROUP BY "Weather_Year", "Weather_Week" """)
def weekly_avg_deduped(spark, sf_dir):
    """Weekly means that count a station's day once, however many copies there are."""
    obs = st.observations(spark, sf_dir).select("STATION", "DATE", "TEMP", "PRCP")
    weekly = aggregate.weekly_avg(dedupe_observations(obs), ["TEMP", "PRCP"])
    return weekly.select(*WEEK_KEY, "record_count", "avg_TEMP", "avg_PRCP")
