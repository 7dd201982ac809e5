"""Queries on scans, landing, cleaning and table writes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from miasma.functions.paths import partition_value
from miasma.operators import aggregate, align, clean
from miasma.plans import bootstrap, incremental
from miasma.plans import standins as st
from miasma.plans.registry import query
from miasma.schema import FLAGS, MEASURES, NUMERIC_MEASURES, RAW_COLUMNS, SENTINELS, WEEK_KEY
from miasma.session import shared_dir
from miasma.sinks import tables
from miasma.sinks.tree import write_csv_tree
from miasma.sources import files, payload

OBS, CASES, WEEKLY = st.SQL_OBS, st.SQL_CASES, st.SQL_WEEKLY
SOME = ["TEMP", "PRCP", "DEWP", "SLP"]
_SUMS = ", ".join(f'sum("{m}") AS "sum_{m}"' for m in NUMERIC_MEASURES)


def _station_totals(obs):
    """Exact per-station totals: enough to tell any lost, doubled or changed value."""
    return obs.groupBy("STATION").agg(
        F.count("*").alias("n"), *[F.sum(m).alias(f"sum_{m}") for m in NUMERIC_MEASURES])


_STATION_TOTALS_SQL = f'WITH {OBS} SELECT "STATION", count(*) AS n, {_SUMS} FROM obs GROUP BY "STATION"'
_MERGED_SQL = f"""WITH {OBS}, {WEEKLY} SELECT "Weather_Year", "Weather_Week", record_count,
  {", ".join(f'round("avg_{m}", 8) AS "avg_{m}"' for m in SOME)} FROM weekly"""


def _merged(weekly):
    """Merged means have passed through a product; eight digits hide its last bit."""
    means = [F.round(f"avg_{m}", 8).alias(f"avg_{m}") for m in SOME]
    return weekly.select(*WEEK_KEY, "record_count", *means)


@query(_STATION_TOTALS_SQL)
def typed_csv_scan(spark, sf_dir):
    """Raw records as CSV files with headers, read back with the declared schema and cleaned."""
    path = shared_dir(spark, "observations-csv")
    st.raw_observations(spark, sf_dir).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    raw = files.read_observation_csv(spark, path)
    return _station_totals(clean.sentinel_to_null(clean.clean_records(raw)))


@query("""SELECT lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS file_station, CAST(year(l_shipdate) AS INTEGER) AS file_year,
    count(*) AS n, count(*) AS own_station, sum(l_quantity) AS sum_temp FROM lineitem GROUP BY ALL""")
def csv_tree_scan(spark, sf_dir):
    """Raw records as a tree of ``<station>-<year>/<station>.csv`` files, station and year read from the
    path. The tree's folders are made of whole groups: one station of one year each. Its files are gzipped."""
    path = shared_dir(spark, "tree")
    raw = st.raw_columns()
    folder = F.concat_ws("-", raw["STATION"], F.substring(raw["DATE"], 1, 4))
    write_csv_tree(st.table(spark, sf_dir, "lineitem"), path, F.concat(F.lit("folder="), folder), [*raw.values()], gzip=True)
    tree = files.read_observation_tree(spark, path, "*.csv.gz")
    station = F.regexp_extract(F.col("_metadata.file_path"), r"folder=([^/-]+)-", 1)
    typed = clean.trim_cast(tree.withColumn("file_station", station))
    return (typed.groupBy("file_station", "file_year")
            .agg(F.count("*").alias("n"), F.count_if(F.col("STATION") == F.col("file_station")).alias("own_station"),
                 F.sum("TEMP").alias("sum_temp")))


@query("""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, sum(l_quantity) AS sum_temp
  FROM lineitem GROUP BY year(l_shipdate)""")
def land_new_files(spark, sf_dir):
    """Two deliveries of CSV files landed as they come, and a run without news: each file once."""
    feed, path = shared_dir(spark, "feed"), shared_dir(spark, "landing")
    raw = st.raw_observations(spark, sf_dir)
    rainy = F.substring("FRSHTT", 2, 1) == "1"
    for part in (raw.filter(rainy), raw.filter(~rainy)):
        part.write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(feed)
        tables.land_new_files(spark, feed, path, lambda paths: files.read_observation_csv(spark, paths))
    tables.land_new_files(spark, feed, path, lambda paths: files.read_observation_csv(spark, paths))
    rows = clean.trim_cast(tables.landed(spark, path))
    return rows.groupBy("year").agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp"))


@query(f"WITH {CASES} SELECT * FROM cases")
def case_file_load(spark, sf_dir):
    """Case counts from CSV, landed as Parquet."""
    csv, parquet = shared_dir(spark, "cases-csv"), shared_dir(spark, "cases")
    st.weekly_cases(spark, sf_dir).write.option("header", True).csv(csv)
    files.read_cases_csv(spark, csv).write.parquet(parquet)
    return files.read_table(spark, parquet)


@query("""SELECT CAST(year(l_shipdate) AS INTEGER) AS path_year, count(*) AS n,
  sum(l_quantity) AS sum_temp FROM lineitem GROUP BY year(l_shipdate)""")
def file_year_from_path(spark, sf_dir):
    """The year of a row taken from the path of its file."""
    path = shared_dir(spark, "by-year")
    obs = st.observations(spark, sf_dir).select("TEMP", F.year("DATE").alias("Weather_Year"))
    tables.write_partitioned(obs, path)
    scan = spark.read.schema("TEMP DOUBLE").option("recursiveFileLookup", True).parquet(path)
    year = partition_value(F.col("_metadata.file_path"), "Weather_Year").cast("int")
    return (scan.select("TEMP", year.alias("path_year")).groupBy("path_year")
            .agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp")))


@query(f"""WITH {OBS}, {WEEKLY}
  SELECT scan, "Weather_Year", "Weather_Week", record_count, "avg_TEMP", "avg_PRCP"
  FROM weekly, (VALUES ('root'), ('folder')) AS s(scan) WHERE "Weather_Year" = 1997""")
def partition_year_scan(spark, sf_dir):
    """One year of the weekly table: by a filter on the whole table, and by its folder."""
    path = shared_dir(spark, "weekly")
    tables.write_partitioned(aggregate.weekly_avg(st.observations(spark, sf_dir), SOME), path)
    by_filter = files.read_table(spark, path).filter(F.col("Weather_Year").cast("int") == 1997)
    by_folder = files.read_year(spark, path, 1997)
    wanted = [*WEEK_KEY, "record_count", "avg_TEMP", "avg_PRCP"]
    return (by_filter.select(F.lit("root").alias("scan"), *wanted)
            .unionByName(by_folder.select(F.lit("folder").alias("scan"), *wanted)))


@query(f"""WITH {OBS} SELECT "Weather_Year", count(DISTINCT "DATE") AS days, count(*) AS n
  FROM obs WHERE "Weather_Year" > 1997 GROUP BY "Weather_Year" """)
def ledger_new_files(spark, sf_dir):
    """Files that came after the first delivery, found by listing and ledger, and their rows."""
    path, ledger = shared_dir(spark, "daily"), shared_dir(spark, "ledger")
    daily = aggregate.daily_avg(st.observations(spark, sf_dir), ["TEMP"])
    tables.write_partitioned(daily, path)
    listed = files.list_files(spark, path)
    old = partition_value(F.col("path"), "Weather_Year").cast("int") <= 1997
    tables.append_ledger(listed.filter(old), ledger)
    fresh = files.new_files(listed, spark.read.parquet(ledger))
    return (files.rows_of_files(files.read_table(spark, path), fresh).groupBy("Weather_Year")
            .agg(F.count("*").alias("days"), F.sum("record_count").alias("n")))


@query("""SELECT lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS "STATION",
    CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, sum(l_quantity) AS sum_temp
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY ALL""")
def land_partitioned(spark, sf_dir):
    """Raw records of the listed stations, kept by year."""
    path = shared_dir(spark, "landing")
    listed = st.station_regions(spark, sf_dir).filter("city = 'ASIA'")
    tables.land_observations(st.raw_observations(spark, sf_dir), path, listed)
    landed = clean.trim_cast(files.read_table(spark, path))
    return (landed.groupBy("STATION", "year")
            .agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp")))


@query(_MERGED_SQL)
def weekly_upsert_first_load(spark, sf_dir):
    """The first delivery meets an empty weekly table."""
    daily = aggregate.daily_avg(st.observations(spark, sf_dir), SOME)
    return _merged(aggregate.weekly_upsert(aggregate.empty_weekly(spark, SOME), daily, measures=SOME))


def _deliveries(spark, sf_dir):
    """All observations in two deliveries that share most weeks: dry days and rainy days."""
    obs = st.observations(spark, sf_dir)
    rainy = F.substring("FRSHTT", 2, 1) == "1"
    return obs.filter(~rainy), obs.filter(rainy)


@query(_MERGED_SQL)
def weekly_upsert(spark, sf_dir):
    """A second delivery merged into the weekly table of the first."""
    first, second = _deliveries(spark, sf_dir)
    existing = aggregate.weekly_avg(first, SOME)
    return _merged(aggregate.weekly_upsert(existing, aggregate.daily_avg(second, SOME), measures=SOME))


@query(_MERGED_SQL)
def versioned_weekly_write(spark, sf_dir):
    """The same merge, stored: version 0, then version 1 made out of version 0."""
    table = tables.VersionedTable(spark, shared_dir(spark, "weekly-versions"))
    first, second = _deliveries(spark, sf_dir)
    table.replace(aggregate.weekly_avg(first, SOME))
    table.replace(aggregate.weekly_upsert(table.read(), aggregate.daily_avg(second, SOME),
                                          measures=SOME))
    return _merged(table.read())


@query(_MERGED_SQL)
def merge_new_files(spark, sf_dir):
    """Daily files of two deliveries, merged as they come; a run without news changes nothing."""
    store, days = bootstrap.Store(spark, shared_dir(spark, "store")), shared_dir(spark, "daily")
    for delivery in _deliveries(spark, sf_dir):
        tables.write_partitioned(aggregate.daily_avg(delivery, SOME), days, mode="append")
        incremental.merge_new_files(store, days, SOME)
    incremental.merge_new_files(store, days, SOME)
    return _merged(store.weekly.read())


def _fields_sql() -> list[str]:
    """The quoted fields of a record line in SQL, padding as in the files."""
    def text(m: str) -> str:
        shown = f"CAST(CAST({st.VALUES[m]} AS BIGINT) AS VARCHAR) || '.0'"
        if m in st.MISSING:
            shown = f"CASE WHEN {st.MISSING[m]} THEN '{SENTINELS[m]}' ELSE {shown} END"
        return f"lpad({shown}, 6, ' ')"

    def field(c: str) -> str:
        m = c.removesuffix("_ATTRIBUTES")
        if c == "STATION":
            return "lpad(CAST(l_suppkey AS VARCHAR), 11, '0')"
        if c == "DATE":
            return "strftime(l_shipdate, '%Y-%m-%d')"
        if c == "NAME":
            return "'STATION ' || l_suppkey || ', ' || l_returnflag"
        if c == "FRSHTT":
            return f"({st.SQL_FLAG_CODE})"
        if c == m:
            return text(m)
        if m in ("MAX", "MIN"):
            return "CASE WHEN l_returnflag = 'A' THEN '*' ELSE ' ' END"
        if m == "PRCP":
            return "CASE WHEN l_discount < 0.005 THEN ' ' ELSE 'G' END"
        readings = "' ' || l_linenumber"
        return f"CASE WHEN {st.MISSING[m]} THEN ' 0' ELSE {readings} END" if m in st.MISSING else readings

    return [f"'\"' || ({field(c)}) || '\"'" for c in RAW_COLUMNS]


@query(f"""SELECT {" || ',' || ".join(_fields_sql())} AS line FROM lineitem""")
def csv_payload_encode(spark, sf_dir):
    """Observations as the quoted lines that go to a broker."""
    lines = payload.encode_payload(st.raw_observations(spark, sf_dir))
    return lines.select(F.col("value").cast("string").alias("line"))


@query(_STATION_TOTALS_SQL)
def trim_cast(spark, sf_dir):
    """Observations to payload lines and back, then trimmed, typed and freed of markers."""
    lines = payload.encode_payload(st.raw_observations(spark, sf_dir))
    return _station_totals(clean.sentinel_to_null(clean.trim_cast(payload.decode_payload(lines))))


@query(f"""WITH {OBS} SELECT "STATION", count(*) AS n, {", ".join(
    f'count("{m}") AS "n_{m}", sum("{m}") AS "sum_{m}"' for m in st.MISSING)}
  FROM obs GROUP BY "STATION" """)
def sentinel_to_null(spark, sf_dir):
    """Readings left per station once markers and empty readings are null."""
    typed = clean.sentinel_to_null(clean.trim_cast(st.raw_observations(spark, sf_dir)))
    return typed.groupBy("STATION").agg(F.count("*").alias("n"), *[
        f(m).alias(f"{name}_{m}") for m in st.MISSING for name, f in (("n", F.count), ("sum", F.sum))])


_KEPT = ["TEMP", "PRCP", "DEWP", "SLP", "GUST"]


@query(f"""WITH {OBS} SELECT "STATION", CAST("DATE" AS VARCHAR) AS "DATE", {", ".join(f'min("{m}") AS "{m}"' for m in MEASURES)}
  FROM obs GROUP BY "STATION", obs."DATE" """)
def dedupe_obs(spark, sf_dir):
    """One row per station and day: each measure's smallest reading, whatever copies lack it."""
    obs = st.observations(spark, sf_dir).select("STATION", "DATE", *MEASURES)
    return clean.dedupe_observations(obs).withColumn("DATE", F.col("DATE").cast("string"))


@query("SELECT CAST(year(l_shipdate) AS INTEGER) AS year, " + ", ".join(
    f"CAST(sum(CASE WHEN {st.FLAG_CONDITIONS[f]} THEN 1 ELSE 0 END) AS BIGINT) AS days_{f}"
    for f in FLAGS) + " FROM lineitem GROUP BY year(l_shipdate)")
def flag_decode(spark, sf_dir):
    """Days with fog, rain, snow, hail, thunder and tornado per year."""
    flags = clean.decode_flags(st.observations(spark, sf_dir))
    return flags.groupBy(F.year("DATE").cast("int").alias("year")).agg(
        *[F.sum(f"flag_{f}").alias(f"days_{f}") for f in FLAGS])


@query("""SELECT CASE event_type WHEN 'signup' THEN 'header' ELSE 'bad date' END AS reason,
  count(*) AS records FROM events WHERE event_type IN ('signup', 'error') GROUP BY event_type""")
def reject_report(spark, sf_dir):
    """Unusable records of the event feed by reason."""
    raw = st.raw_events(st.table(spark, sf_dir, "events"), dirty=True)
    return clean.reject_report(payload.decode_payload(payload.encode_payload(raw)))


@query(f"""WITH l AS (SELECT l_orderkey % 31 AS k, [{", ".join(_fields_sql())}] AS f FROM lineitem)
  SELECT CASE k WHEN 30 THEN 'long line' ELSE 'short line' END AS reason, CAST(CASE k WHEN 30 THEN 29 ELSE k END AS INTEGER) AS fields,
    CASE k WHEN 30 THEN array_to_string(f, ',') || ',1' ELSE array_to_string(f[1:k], ',') END AS text
  FROM l WHERE k BETWEEN 1 AND 27 OR k = 30""")
def rejected_lines(spark, sf_dir):
    """Record lines cut after each of their fields, too long ones, whole ones, and whole ones that are empty
    behind the date: reason, fields and text of those that are no records."""
    keyed = st.raw_observations(spark, sf_dir, keep=("l_orderkey",))
    keyed = keyed.select("l_orderkey", payload.encoded(RAW_COLUMNS).cast("string").alias("line"))
    k, line = F.col("l_orderkey") % 31, F.col("line")

    def first(n) -> Column:
        """The first fields of a line, up to the n-th comma between quotes."""
        head = F.call_function("substring_index", line, F.lit('","'), n)
        return F.when(F.length(head) < F.length(line), F.concat(head, F.lit('"'))).otherwise(line)

    text = (F.when(k.between(1, 27), first(F.greatest(k, F.lit(1)).cast("int")))
            .when(k == 29, F.concat_ws(",", first(F.lit(2)), F.lit('""' + ',""' * 25)))
            .when(k == 30, F.concat(line, F.lit(",1"))).otherwise(line))
    return clean.quarantine(payload.decode_payload(keyed.select(text.cast("binary").alias("value")), keep_text=True))


@query(f"""WITH {OBS} SELECT "STATION", count(*) AS n, sum("TEMP") AS sum_temp, sum("GUST") AS sum_gust
  FROM obs WHERE "DEWP" IS NOT NULL AND "SLP" IS NOT NULL AND "PRCP" IS NOT NULL
    AND "GUST" IS NOT NULL GROUP BY "STATION" """)
def drop_null_rows(spark, sf_dir):
    """Only observations with all of five measures."""
    obs = clean.drop_null_rows(st.observations(spark, sf_dir).select("STATION", *_KEPT))
    return obs.groupBy("STATION").agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp"),
                                      F.sum("GUST").alias("sum_gust"))


@query(f"WITH {CASES} SELECT * FROM cases WHERE city = 'ASIA'")
def region_filter(spark, sf_dir):
    return clean.region_filter(st.weekly_cases(spark, sf_dir), "ASIA")


@query(f"""WITH {OBS}, means AS (SELECT "STATION", "Weather_Year", "Weather_Week", avg("PRCP") AS prcp,
    avg("DEWP") AS dewp FROM obs GROUP BY "STATION", "Weather_Year", "Weather_Week")
  SELECT filled, "Weather_Year", count(*) AS n, count(*) FILTER (coalesce(prcp, 0) = 0) AS zero_prcp,
    count(*) FILTER (filled = 'one' AND dewp IS NULL) AS null_dewp
  FROM means, (VALUES ('one'), ('all')) AS f(filled) GROUP BY filled, "Weather_Year" """)
def fill_defaults(spark, sf_dir):
    """Station-weeks after nulls became 0 in one named column, and in all numeric columns."""
    weekly = aggregate.weekly_avg(st.observations(spark, sf_dir), ["PRCP", "DEWP"], keys=("STATION",))
    means = weekly.select("STATION", *WEEK_KEY, "avg_PRCP", "avg_DEWP")
    both = (clean.fill_defaults(means, ["avg_PRCP"]).withColumn("filled", F.lit("one"))
            .unionByName(clean.fill_defaults(means).withColumn("filled", F.lit("all"))))
    return both.groupBy("filled", "Weather_Year").agg(
        F.count("*").alias("n"), F.count_if(F.col("avg_PRCP") == 0).alias("zero_prcp"),
        F.count_if(F.col("avg_DEWP").isNull()).alias("null_dewp"))


@query(f"""WITH {OBS} SELECT "Weather_Year", "Weather_Week", count(*) AS record_count,
    avg("TEMP") AS "avg_TEMP", CAST(NULL AS DOUBLE) AS "avg_PRCP"
  FROM obs GROUP BY "Weather_Year", "Weather_Week" """)
def schema_align(spark, sf_dir):
    """A table with an extra and a missing column brought to another one's schema."""
    have = aggregate.weekly_avg(st.observations(spark, sf_dir), ["TEMP"])
    target = spark.createDataFrame([], "Weather_Year INT, Weather_Week INT, record_count BIGINT, "
                                       "avg_TEMP DOUBLE, avg_PRCP DOUBLE").schema
    return align.align_schema(have, target)


@query(f"""WITH {OBS}
  SELECT "Weather_Year", "Weather_Week", avg("TEMP") AS "avg_TEMP", CAST(NULL AS DOUBLE) AS "avg_SLP"
  FROM obs WHERE substr("FRSHTT", 2, 1) <> '1' GROUP BY ALL
  UNION ALL
  SELECT "Weather_Year", "Weather_Week", CAST(NULL AS DOUBLE), avg("SLP")
  FROM obs WHERE substr("FRSHTT", 2, 1) = '1' GROUP BY ALL""")
def union_missing_columns(spark, sf_dir):
    """Weekly tables with different measures, one below the other."""
    first, second = _deliveries(spark, sf_dir)
    return align.union_missing_columns(
        aggregate.weekly_avg(first, ["TEMP"]).select(*WEEK_KEY, "avg_TEMP"),
        aggregate.weekly_avg(second, ["SLP"]).select(*WEEK_KEY, "avg_SLP"))


@query(f"""WITH {OBS} SELECT "STATION", CAST("DATE" AS VARCHAR) AS "DATE", "TEMP", "SLP" FROM obs
  ORDER BY "TEMP" DESC, "SLP" DESC NULLS LAST, "STATION", obs."DATE" LIMIT 10""")
def preview_limit(spark, sf_dir):
    """The ten warmest observations."""
    obs = st.observations(spark, sf_dir).select("STATION", "DATE", "TEMP", "SLP")
    top = obs.orderBy(F.desc("TEMP"), F.desc_nulls_last("SLP"), "STATION", "DATE").limit(10)
    return top.withColumn("DATE", F.col("DATE").cast("string"))


@query("SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem ORDER BY year")
def changed_years(spark, sf_dir):
    """The years that a delivery of daily means touches."""
    return aggregate.changed_years(aggregate.daily_avg(st.observations(spark, sf_dir), ["TEMP"]))
