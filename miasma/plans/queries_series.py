"""Queries on regions as inputs, time series, forecasts that feed on forecasts, and neighbours."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from miasma.operators import features, geo, metrics, model, regional, series
from miasma.plans import bootstrap, incremental
from miasma.plans import standins as st
from miasma.plans.queries_model import _AHEAD, _IS_TEST, _REGIONAL, _cases, _in_bounds, _regional_store, _week
from miasma.plans.registry import query
from miasma.session import shared_dir

OBS, CASES = st.SQL_OBS, st.SQL_CASES
LAGS = list(series.LAGS)


# ---- the region as a category ----

@query(f"""WITH {OBS}, {CASES}, {_REGIONAL}, rows AS (SELECT * FROM cases JOIN regional USING (city, year, weekofyear))
  SELECT city, count(*) AS n, CAST(0 AS BIGINT) AS changed, TRUE AS in_bounds, TRUE AS unseen_in_bounds,
    (SELECT count(DISTINCT city) FROM rows WHERE NOT ({_IS_TEST})) AS regions, TRUE AS region_matters
  FROM rows WHERE {_IS_TEST} GROUP BY city""")
def rf_region_input(spark, sf_dir):
    """A forest with the region among its inputs, stored and loaded: test rows per region, how many score
    otherwise after loading, bounds with the own and with an unknown region, the number of regions,
    and whether the region alone changes a score."""
    store = _regional_store(spark, sf_dir, st.weekly_cases(spark, sf_dir))
    train, test = store.features(is_test=False), store.features(is_test=True)
    forest = store.model()
    again = model.load_model(spark, model.save_model(forest, spark, shared_dir(spark, "copy")).rsplit("/", 1)[0], PipelineModel)

    def scored(by, rows, name):
        return model.score(by, rows).select("key", F.col("prediction").alias(name))

    rows = test.withColumn("key", F.struct("city", "year", "weekofyear"))
    first = rows.agg(F.min("city")).scalar()
    all_of = (scored(forest, rows, "prediction").join(scored(again, rows, "loaded"), "key")
              .join(scored(forest, rows.withColumn("city", F.lit("no such region")), "unseen"), "key")
              .join(scored(forest, rows.withColumn("city", first), "moved"), "key"))
    found = _in_bounds(_in_bounds(all_of, train, "unseen").withColumnRenamed("in_bounds", "unseen_in"), train)
    matters = all_of.agg(F.max(F.abs(F.col("prediction") - F.col("moved"))) > 0).scalar()
    return (found.groupBy(F.col("key.city").alias("city"))
            .agg(F.count("*").alias("n"), F.count_if(F.col("loaded") != F.col("prediction")).alias("changed"),
                 F.every("in_bounds").alias("in_bounds"), F.every("unseen_in").alias("unseen_in_bounds"))
            .withColumns({"regions": F.lit(len(model.known_regions(again))).cast("bigint"), "region_matters": matters}))


# ---- forecasts that feed on forecasts ----

@query(f"""WITH {_AHEAD}, values_ AS (SELECT city, year, weekofyear, FALSE AS scored FROM cases
    UNION ALL SELECT city, year, weekofyear, TRUE FROM ahead),
  seen AS (SELECT *, lag(scored, 1) OVER w AS a, lag(scored, 2) OVER w AS b, lag(scored, 3) OVER w AS c FROM values_
    WINDOW w AS (PARTITION BY city ORDER BY year, weekofyear))
  SELECT city, year, weekofyear, a AS scored_lag, b AS scored_lag_2, c AS scored_lag_3, TRUE AS in_bounds FROM seen WHERE scored""")
def rf_recursive_forecast(spark, sf_dir):
    """Weeks without cases forecast one after the other per region: which of a week's lags are forecasts
    themselves."""
    cases = _cases(spark, sf_dir)
    store = _regional_store(spark, sf_dir, cases)
    scored = incremental.recursive_forecast(store, cases)
    scored = _in_bounds(scored, store.features(is_test=False))
    lags = [F.get("scored_lags", i).alias(n) for i, n in enumerate(("scored_lag", "scored_lag_2", "scored_lag_3"))]
    return scored.select(*_week("city"), *lags, "in_bounds")


@query(f"""WITH {_AHEAD}, values_ AS (SELECT city, year, weekofyear, CAST(total_cases AS DOUBLE) AS v, FALSE AS scored FROM cases
    UNION ALL SELECT city, year, weekofyear, 7.0, TRUE FROM ahead),
  seen AS (SELECT *, {", ".join(f"coalesce(lag(v, {k}) OVER w, 0) AS {n}" for k, n in enumerate(LAGS, start=1))} FROM values_
    WINDOW w AS (PARTITION BY city ORDER BY year, weekofyear))
  SELECT city, year, weekofyear, {", ".join(LAGS)} FROM seen WHERE scored""")
def recursive_lags(spark, sf_dir):
    """Lags of all weeks to forecast if every forecast is 7."""
    cases = _cases(spark, sf_dir)
    store = bootstrap.Store(spark, shared_dir(spark, "regional-store"), regional=True)
    store.weekly.replace(regional.regional_weekly(st.observations(spark, sf_dir), st.station_regions(spark, sf_dir), ["TEMP", "PRCP", "DEWP"]))
    constant = lambda rows: rows.withColumn("prediction", F.lit(7.0))
    return incremental.recursive_forecast(store, cases, constant).select(*_week("city"), *LAGS)


# ---- least squares ----

_YEARS = "((make_date(year, 1, 1) + CAST((weekofyear - 1) * 7 AS INTEGER)) - DATE '2000-01-01') / 365.25"
_TERMS = {"constant": "1.0", "trend": _YEARS, "sin_1": f"sin(2 * pi() * {_YEARS})", "cos_1": f"cos(2 * pi() * {_YEARS})",
          "sin_2": f"sin(4 * pi() * {_YEARS})", "cos_2": f"cos(4 * pi() * {_YEARS})",
          **{c: f"CAST({c} AS DOUBLE)" for c in LAGS}}


@query(f"""WITH {CASES}, {st.SQL_LAGGED}, x AS (SELECT city, CAST(total_cases AS DOUBLE) AS y, {", ".join(f"{e} AS {n}" for n, e in _TERMS.items())}
    FROM lagged WHERE lag_cases_3 IS NOT NULL),
  long AS (UNPIVOT x ON {", ".join(_TERMS)} INTO NAME term VALUE v)
  SELECT city, term, count(*) AS n, round(sum(v * v), 3) + 0.0 AS xx, round(sum(v * y), 3) + 0.0 AS xy, TRUE AS orthogonal
  FROM long GROUP BY city, term""")
def harmonic_forecast(spark, sf_dir):
    """Per region a least-squares fit on trend, two waves of the year and three lags: the sums it comes
    from, and whether what it leaves over is orthogonal to every term."""
    rows = features.add_case_lags(_cases(spark, sf_dir))
    terms = series.terms(harmonics=2, lags=LAGS)
    fitted = series.fit_series(rows, terms)
    left = series.predict_series(fitted, rows, terms).dropna(subset=["prediction"])
    rest = F.col("total_cases") - F.col("prediction")
    checked = left.groupBy("city").agg(F.array(*[
        F.abs(F.sum(rest * t)) <= 1e-7 * F.sum(F.abs(F.col("total_cases") * t)) + 1e-7 for t in terms.values()]).alias("orthogonal"))
    each = F.arrays_zip("names", F.transform("xx", lambda row, i: F.get(row, i)).alias("xx"), "xy", "orthogonal")
    return (fitted.join(checked, "city").select("city", "n", F.explode(each).alias("t"))
            .select("city", F.col("t.names").alias("term"), "n", (F.round("t.xx", 3) + F.lit(0.0)).alias("xx"),
                    (F.round("t.xy", 3) + F.lit(0.0)).alias("xy"), F.col("t.orthogonal").alias("orthogonal")))


@query(f"""WITH {CASES}, x AS (SELECT city, total_cases AS y, {_YEARS} AS years FROM cases)
  SELECT city, count(*) AS n, round(regr_intercept(y, years), 6) + 0.0 AS intercept, round(regr_slope(y, years), 6) + 0.0 AS slope,
    round(regr_syy(y, years) * (1 - regr_r2(y, years)), 4) + 0.0 AS sse FROM x GROUP BY city""")
def series_line(spark, sf_dir):
    """The same fit with a constant and a trend alone is the line that SQL's regression gives."""
    found = series.fit_series(_cases(spark, sf_dir), series.terms(harmonics=0))
    return found.select("city", "n", *[(F.round(c, d) + F.lit(0.0)).alias(n) for c, d, n in (
        (F.get("coefficients", 0), 6, "intercept"), (F.get("coefficients", 1), 6, "slope"), (F.col("sse"), 4, "sse"))])


@query(f"""WITH {CASES}, last AS (SELECT city, max(year * 100 + weekofyear) AS k FROM cases GROUP BY city),
  ahead AS (SELECT city, (k // 100) * 52 + least(k % 100, 52) - 1 + h AS k52 FROM last, range(1, 27) r(h))
  SELECT city, CAST(k52 // 52 AS INTEGER) AS year, CAST(k52 % 52 + 1 AS INTEGER) AS weekofyear, TRUE AS finite FROM ahead""")
def harmonic_weeks_ahead(spark, sf_dir):
    """Half a year ahead of each region's last count, from trend and waves."""
    cases, terms = _cases(spark, sf_dir), series.terms(harmonics=2)
    scored = series.predict_series(series.fit_series(cases, terms), series.weeks_after(cases, 26), terms)
    return scored.select("city", "year", "weekofyear", (F.abs("prediction") < 1e9).alias("finite"))


# ---- neighbours ----

def _km(a: str, b: str) -> str:
    return (f"2 * {geo.EARTH_KM} * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * "
            f"cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))")


_STATIONS = """stations AS (SELECT "STATION", avg("LATITUDE") AS lat, avg("LONGITUDE") AS lon FROM obs GROUP BY "STATION")"""


@query(f"""WITH {OBS}, {_STATIONS} SELECT a."STATION" AS "STATION", b."STATION" AS neighbour, round({_km("a", "b")}, 6) AS km
  FROM stations a, stations b WHERE a."STATION" <> b."STATION" AND {_km("a", "b")} <= 200""")
def near_stations(spark, sf_dir):
    """Stations at most 200 km apart, found through cells."""
    at = (st.observations(spark, sf_dir).groupBy("STATION")
          .agg(F.avg("LATITUDE").alias("latitude"), F.avg("LONGITUDE").alias("longitude")))
    return geo.near_places(at, 200.0, "STATION").withColumn("km", F.round("km", 6))


_NATION_CASES = CASES.replace("r_name", "n_name")
_NATION_PLACES = """nation_of AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS "STATION", n_name AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
  places AS (SELECT city, avg(lat) AS lat, avg(lon) AS lon FROM stations JOIN nation_of USING ("STATION") GROUP BY city)"""
_NEAR = f"""near AS (SELECT a.city AS city, b.city AS neighbour FROM places a, places b
    WHERE a.city <> b.city AND {_km("a", "b")} <= 1200)"""


@query(f"""WITH {OBS}, {_STATIONS}, {_NATION_PLACES}, {_NEAR}, {_NATION_CASES}, {st.SQL_LAGGED},
  met AS (SELECT c.city, c.year, c.weekofyear, avg(l.lag_cases) AS m, count(*) AS n FROM cases c JOIN near USING (city)
    JOIN lagged l ON l.city = neighbour AND l.year = c.year AND l.weekofyear = c.weekofyear
    WHERE l.lag_cases IS NOT NULL GROUP BY ALL)
  SELECT city, year, weekofyear, round(coalesce(m, 0), 8) AS neighbour_cases, CAST(coalesce(n, 0) AS DOUBLE) AS neighbours
  FROM cases LEFT JOIN met USING (city, year, weekofyear)""")
def neighbour_lags(spark, sf_dir):
    """For each week of each nation what its neighbours counted before, as inputs of a model."""
    cases = st.stored(spark, st.weekly_cases(spark, sf_dir, "n_name"), "nation-cases")
    places = geo.station_places(st.observations(spark, sf_dir), st.station_regions(spark, sf_dir, "n_name"))
    rows = geo.add_neighbour_lags(cases, cases, geo.near_places(places, 1200.0))
    return rows.select("city", "year", "weekofyear", F.round("neighbour_cases", 8).alias("neighbour_cases"), "neighbours")


# ---- lags by week, evaluation in order of time ----

_HOLED = "holed AS (SELECT * FROM cases WHERE (weekofyear + year + length(city)) % 9 <> 0)"


@query(f"""WITH {CASES}, {_HOLED},
  spine AS (SELECT y AS year, w AS weekofyear FROM range((SELECT min(year) FROM holed), (SELECT max(year) + 1 FROM holed)) a(y), range(1, 53) b(w)
    UNION SELECT year, weekofyear FROM holed),
  pos AS (SELECT year, weekofyear, row_number() OVER (ORDER BY year, weekofyear) AS k FROM spine),
  placed AS (SELECT * FROM holed JOIN pos USING (year, weekofyear))
  SELECT p.city, p.year, p.weekofyear, p.total_cases, a.total_cases AS lag_cases, b.total_cases AS lag_cases_2, c.total_cases AS lag_cases_3
  FROM placed p LEFT JOIN placed a ON a.city = p.city AND a.k = p.k - 1 LEFT JOIN placed b ON b.city = p.city AND b.k = p.k - 2
    LEFT JOIN placed c ON c.city = p.city AND c.k = p.k - 3""")
def case_lags_by_week(spark, sf_dir):
    """Counts one, two and three weeks before where weeks are missing."""
    holed = st.weekly_cases(spark, sf_dir).filter((F.col("weekofyear") + F.col("year") + F.length("city")) % 9 != 0)
    return features.add_case_lags_by_week(holed)


_CUTS = [(1990, 1), (1996, 1), (1997, 1), (1998, 1)]
_FOLD = " + ".join(f"CAST(year * 100 + weekofyear >= {y * 100 + w} AS INTEGER)" for y, w in _CUTS)


@query(f"""WITH {OBS}, {CASES}, {_REGIONAL}, rows AS (SELECT *, {_FOLD} AS fold FROM cases JOIN regional USING (city, year, weekofyear))
  SELECT fold, count(*) AS n, (SELECT count(*) FROM rows t WHERE t.fold < r.fold) AS n_train,
    CAST((SELECT max(year * 100 + weekofyear) FROM rows t WHERE t.fold < r.fold) AS INTEGER) AS train_until,
    CAST(min(year * 100 + weekofyear) AS INTEGER) AS first_week, TRUE AS fits
  FROM rows r WHERE fold > (SELECT min(fold) FROM rows) GROUP BY fold""")
def rolling_evaluation(spark, sf_dir):
    """Forests, each scored on weeks after all it has seen: rows, last week seen and first week scored
    per fold; ``fits``: errors are in order and no score is of a week before the last one seen."""
    store = bootstrap.Store(spark, shared_dir(spark, "regional-store"), regional=True)
    store.weekly.replace(regional.regional_weekly(st.observations(spark, sf_dir), st.station_regions(spark, sf_dir), ["TEMP", "PRCP", "DEWP"]))
    rows = st.stored(spark, store.feature_rows(st.weekly_cases(spark, sf_dir)), "rows")
    scored = st.stored(spark, model.rolling_evaluation(rows, _CUTS, fit=model.train_region_forest, numTrees=30), "scored")
    number = lambda y, w: (F.col(y).cast("int") * 100 + F.col(w).cast("int"))
    week = number("year", "weekofyear")
    found = scored.groupBy("fold").agg(F.max("n_train").alias("n_train"), F.max(number("train_until.year", "train_until.weekofyear")).alias("train_until"),
                                       F.min(week).alias("first_week"))
    errors = metrics.regression_metrics(scored, keys=("fold",)).select("fold", "n", (F.col("mae") <= F.col("rmse") + 1e-9).alias("ordered"))
    return found.join(errors, "fold").select("fold", "n", "n_train", "train_until", "first_week",
                                             (F.col("ordered") & (F.col("train_until") < F.col("first_week"))).alias("fits"))
