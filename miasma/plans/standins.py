"""Observations and case counts out of the general test tables, for Spark and for SQL.

Measures are whole numbers, so sums and means are exact in double arithmetic and do not
depend on the order in which partitions are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.schema import FLAGS, MEASURES, RAW_COLUMNS, SENTINELS
from miasma.session import shared_dir

# Each FRSHTT digit is one condition on a lineitem row; the texts hold in Spark and DuckDB.
FLAG_CONDITIONS = {
    "fog": "l_returnflag = 'R'",
    "rain": "l_discount > 0.045",
    "snow": "l_tax > 0.055",
    "hail": "l_linestatus = 'F'",
    "thunder": "l_linenumber >= 5",
    "tornado": "l_quantity >= 45",
}
# Value of each numeric measure.
VALUES = {
    "LATITUDE": "l_suppkey % 90",
    "LONGITUDE": "l_suppkey % 180",
    "ELEVATION": "l_partkey % 2000",
    "TEMP": "l_quantity",
    "DEWP": "round(l_tax * 100)",
    "SLP": "floor(l_extendedprice / 100)",
    "STP": "l_orderkey % 900",
    "VISIB": "l_linenumber",
    "WDSP": "l_partkey % 40",
    "MXSPD": "l_partkey % 40 + 5",
    "GUST": "l_partkey % 40 + 10",
    "MAX": "l_quantity + 10",
    "MIN": "l_quantity - 10",
    "PRCP": "round(l_discount * 100)",
    "SNDP": "0",
}
# When a measure carries its missing-value marker.
MISSING = {
    "DEWP": "l_tax < 0.005",
    "SLP": "l_linenumber = 7",
    "STP": "l_linestatus = 'F'",
    "GUST": "l_returnflag = 'N'",
    "PRCP": "l_discount < 0.005",
    "SNDP": "l_quantity > 0",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A small table written and read back, for use in several places of a plan."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _flag_code() -> Column:
    return F.concat(*[F.expr(f"CASE WHEN {FLAG_CONDITIONS[f]} THEN '1' ELSE '0' END")
                      for f in FLAGS])


def _station() -> Column:
    return F.lpad(F.col("l_suppkey").cast("string"), 11, "0")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, clean observations: missing measures are null, ``DATE`` is a date."""
    def value(m: str) -> Column:
        v = F.expr(VALUES[m]).cast("double")
        return (F.when(~F.expr(MISSING[m]), v) if m in MISSING else v).alias(m)

    return _lineitem(spark, sf_dir).select(
        _station().alias("STATION"), F.col("l_shipdate").cast("date").alias("DATE"),
        *[value(m) for m in VALUES], _flag_code().alias("FRSHTT"))


def raw_observations(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    """The same observations as 28 padded text columns, markers and reading counts included. ``keep``
    names columns of the table to stay beside them."""
    return _lineitem(spark, sf_dir).select(*raw_columns().values(), *keep)


def raw_columns() -> dict[str, Column]:
    """The 28 text columns by name, over the columns of the table."""
    def text(m: str) -> Column:
        shown = F.concat(F.expr(VALUES[m]).cast("bigint").cast("string"), F.lit(".0"))
        if m in MISSING:
            shown = F.when(F.expr(MISSING[m]), F.lit(str(SENTINELS[m]))).otherwise(shown)
        return F.lpad(shown, 6, " ")

    def attribute(m: str) -> Column:
        if m in ("MAX", "MIN"):
            return F.expr("CASE WHEN l_returnflag = 'A' THEN '*' ELSE ' ' END")
        if m == "PRCP":
            return F.expr("CASE WHEN l_discount < 0.005 THEN ' ' ELSE 'G' END")
        readings = F.concat(F.lit(" "), F.col("l_linenumber").cast("string"))
        if m in MISSING:
            return F.when(F.expr(MISSING[m]), F.lit(" 0")).otherwise(readings)
        return readings

    made = {
        "STATION": _station(),
        "DATE": F.col("l_shipdate").cast("date").cast("string"),
        "NAME": F.concat(F.lit("STATION "), F.col("l_suppkey").cast("string"), F.lit(", "),
                         F.col("l_returnflag")),
        "FRSHTT": _flag_code(),
    }

    def column(c: str) -> Column:
        if c in made:
            return made[c].alias(c)
        if c.endswith("_ATTRIBUTES"):
            return attribute(c.removesuffix("_ATTRIBUTES")).alias(c)
        return text(c).alias(c)

    return {c: column(c) for c in RAW_COLUMNS}


def raw_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    """Events as station-day records: user = station, day = ``DATE``, value in hundredths = TEMP.

    With ``dirty``, sign-ups arrive as header lines and errors with a date that is none.
    Works on a stream as well.
    """
    date = F.col("ts").cast("date").cast("string")
    station = F.lpad(F.col("user_id").cast("string"), 11, "0")
    if dirty:
        header = F.col("event_type") == "signup"
        date = (F.when(header, F.lit("DATE"))
                .when(F.col("event_type") == "error", F.lit("n/a")).otherwise(date))
        station = F.when(header, F.lit("STATION")).otherwise(station)
    made = {
        "STATION": station, "DATE": date, "NAME": F.col("event_type"),
        "TEMP": F.lpad(F.round(F.col("value") * 100).cast("bigint").cast("string"), 8, " "),
    }
    return events.select(*[made.get(c, F.lit("")).alias(c) for c in RAW_COLUMNS])


def weekly_cases(spark: SparkSession, sf_dir: str, place: str = "city") -> DataFrame:
    """Orders per region and week as (city, year, weekofyear, total_cases); with ``place="n_name"``
    a nation takes the part of a region.

    Orders shrink to customer-weeks before they meet the customer table, so a customer with
    very many orders moves as few rows as any other.
    """
    date = F.col("o_orderdate")
    per_customer = (table(spark, sf_dir, "orders")
                    .groupBy("o_custkey", F.year(date).cast("int").alias("year"),
                             F.weekofyear(date).cast("int").alias("weekofyear"))
                    .agg(F.count("*").alias("n")))
    places = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
              .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
              .select("c_custkey", F.col(place).alias("city")))
    return (per_customer.join(places, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("city", "year", "weekofyear")
            .agg(F.sum("n").cast("int").alias("total_cases")))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return (table(spark, sf_dir, "nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", F.col("r_name").alias("city")))


def station_regions(spark: SparkSession, sf_dir: str, place: str = "city") -> DataFrame:
    """Station → region (or nation), from suppliers."""
    return (table(spark, sf_dir, "supplier")
            .join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.lpad(F.col("s_suppkey").cast("string"), 11, "0").alias("STATION"), F.col(place).alias("city")))


# ---- the same tables as SQL, to be put after WITH ----

def _sql_value(m: str) -> str:
    v = f"CAST({VALUES[m]} AS DOUBLE)"
    return (f"CASE WHEN NOT ({MISSING[m]}) THEN {v} END" if m in MISSING else v) + f' AS "{m}"'


SQL_FLAG_CODE = " || ".join(f"CASE WHEN {FLAG_CONDITIONS[f]} THEN '1' ELSE '0' END" for f in FLAGS)
SQL_OBS = f"""obs AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS "STATION", CAST(l_shipdate AS DATE) AS "DATE",
    CAST(year(l_shipdate) AS INTEGER) AS "Weather_Year", CAST(week(l_shipdate) AS INTEGER) AS "Weather_Week",
    {", ".join(_sql_value(m) for m in VALUES)}, {SQL_FLAG_CODE} AS "FRSHTT"
  FROM lineitem)"""
SQL_CASES = """cases AS (
  SELECT r_name AS city, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(week(o_orderdate) AS INTEGER) AS weekofyear, CAST(count(*) AS INTEGER) AS total_cases
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name, year(o_orderdate), week(o_orderdate))"""


def sql_avgs(measures=MEASURES) -> str:
    return ", ".join(f'avg(CAST("{m}" AS DOUBLE)) AS "avg_{m}"' for m in measures)


def sql_counts(measures=MEASURES) -> str:
    return ", ".join(f'count("{m}") AS "n_{m}"' for m in measures)


SQL_WEEKLY = f"""weekly AS (
  SELECT "Weather_Year", "Weather_Week", count(*) AS record_count, {sql_avgs()}, {sql_counts()}
  FROM obs GROUP BY "Weather_Year", "Weather_Week")"""
SQL_LAGGED = """lagged AS (
  SELECT *, lag(total_cases, 1) OVER w AS lag_cases, lag(total_cases, 2) OVER w AS lag_cases_2,
    lag(total_cases, 3) OVER w AS lag_cases_3
  FROM cases WINDOW w AS (PARTITION BY city ORDER BY year, weekofyear))"""
SQL_FEATURES = """features AS (
  SELECT city, CAST(year AS DOUBLE) AS year, CAST(weekofyear AS DOUBLE) AS weekofyear, total_cases,
    coalesce("avg_TEMP", 0) AS "avg_TEMP", coalesce("avg_PRCP", 0) AS "avg_PRCP",
    coalesce("avg_DEWP", 0) AS "avg_DEWP",
    CAST(coalesce(lag_cases, 0) AS DOUBLE) AS lag_cases,
    CAST(coalesce(lag_cases_2, 0) AS DOUBLE) AS lag_cases_2,
    CAST(coalesce(lag_cases_3, 0) AS DOUBLE) AS lag_cases_3,
    sin(2 * pi() * weekofyear / 52) AS sin_week, cos(2 * pi() * weekofyear / 52) AS cos_week,
    coalesce("avg_TEMP" * "avg_PRCP", 0) AS temp_prcp_interaction
  FROM lagged JOIN weekly ON year = "Weather_Year" AND weekofyear = "Weather_Week")"""
