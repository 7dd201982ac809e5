"""Streaming queries: the event table as a feed of records. Each runs until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from miasma.operators import clean
from miasma.plans import standins as st
from miasma.plans.registry import query
from miasma.schema import WEEK_KEY
from miasma.session import shared_dir
from miasma.sinks import tables
from miasma.sources import files, payload
from miasma.streaming import daily, upsert
from miasma.streaming.sources import stream_lines, stream_parquet

_EVENTS = """e AS (SELECT lpad(CAST(user_id AS VARCHAR), 11, '0') AS "STATION", CAST(ts AS DATE) AS "DATE",
    event_type, round(value * 100) AS "TEMP" FROM events)"""
_WEEKS = """CAST(year("DATE") AS INTEGER) AS "Weather_Year", CAST(week("DATE") AS INTEGER) AS "Weather_Week" """
_DONE = """(SELECT max("DATE") - 7 FROM e)"""
_DAYS = f"""SELECT {_WEEKS}, CAST("DATE" AS VARCHAR) AS "DATE", count(*) AS record_count,
    avg("TEMP") AS "avg_TEMP" FROM e"""
DAY = [*WEEK_KEY, "DATE", "record_count", "avg_TEMP"]


def _feed(sf_dir):
    """The event table, written as a glob: a file stream takes a lone file only that way."""
    return f"{sf_dir}/{{events.parquet}}"


def _records(spark, path, dirty=False):
    """The feed as broker records, one payload line per event."""
    return payload.encode_payload(st.raw_events(stream_parquet(spark, path), dirty))


def _run(spark, stream, name, **kwargs):
    """Drain a stream into a fresh folder and read it back."""
    path = shared_dir(spark, name)
    daily.run_available(stream, path, f"{path}-checkpoint", **kwargs)
    return files.read_table(spark, path)


def _days(table):
    return table.withColumn("DATE", F.col("DATE").cast("date").cast("string")).select(DAY)


@query(f"""WITH {_EVENTS} SELECT event_type AS "NAME", CAST("DATE" AS VARCHAR) AS "DATE", count(*) AS n,
  sum("TEMP") AS sum_temp FROM e GROUP BY event_type, e."DATE" """)
def stream_parse_payload(spark, sf_dir):
    """Payload lines of a stream parsed into columns."""
    parsed = payload.decode_payload(_records(spark, _feed(sf_dir)))
    landed = clean.trim_cast(_run(spark, parsed, "parsed", partition_by=()))
    return (landed.groupBy("NAME", F.col("DATE").cast("date").cast("string").alias("DATE"))
            .agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp")))


@query(f"""WITH {_EVENTS} SELECT "STATION", CAST("DATE" AS VARCHAR) AS "DATE", count(*) AS n, sum("TEMP") AS sum_temp
  FROM e WHERE event_type NOT IN ('signup', 'error') GROUP BY "STATION", e."DATE" """)
def stream_clean_filter(spark, sf_dir):
    """A stream with header lines and bad dates, cleaned."""
    good = clean.clean_records(payload.decode_payload(
        _records(spark, _feed(sf_dir), dirty=True)))
    landed = _run(spark, good, "clean", partition_by=())
    return (landed.groupBy("STATION", F.col("DATE").cast("date").cast("string").alias("DATE"))
            .agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp")))


@query(f"""WITH {_EVENTS} {_DAYS} WHERE e."DATE" <= {_DONE} GROUP BY e."DATE" """)
def stream_daily_avg(spark, sf_dir):
    """Daily means of the days that the watermark has passed."""
    means = daily.daily_stream(_records(spark, _feed(sf_dir)), ["TEMP"])
    return _days(_run(spark, means, "daily", files_per_batch=1))


@query(f"""WITH {_EVENTS}, first_done AS (SELECT max("DATE") - 7 AS d FROM e WHERE event_type <> 'error')
  {_DAYS}, first_done WHERE e."DATE" <= {_DONE} AND (event_type <> 'error' OR e."DATE" > d) GROUP BY e."DATE" """)
def stream_late_drop(spark, sf_dir):
    """Errors arrive after everything else: those behind the watermark do not count."""
    feed, out = shared_dir(spark, "feed"), shared_dir(spark, "daily")
    events = st.table(spark, sf_dir, "events")
    for wave in (events.filter("event_type <> 'error'"), events.filter("event_type = 'error'")):
        wave.write.mode("append").parquet(feed)
        means = daily.daily_stream(_records(spark, feed), ["TEMP"])
        daily.run_available(means, out, f"{out}-checkpoint", files_per_batch=1)
    return _days(files.read_table(spark, out))


@query(f"""WITH {_EVENTS}, once AS (SELECT "STATION", "DATE", min("TEMP") AS "TEMP" FROM e GROUP BY ALL)
  SELECT {_WEEKS}, CAST("DATE" AS VARCHAR) AS "DATE", count(*) AS record_count, avg("TEMP") AS "avg_TEMP"
  FROM once WHERE "DATE" <= {_DONE} GROUP BY once."DATE" """)
def stream_dedupe(spark, sf_dir):
    """Daily means that count a station's day once, however often it reports."""
    means = daily.daily_stream(_records(spark, _feed(sf_dir)), ["TEMP"], dedupe=True)
    return _days(_run(spark, means, "deduped", files_per_batch=1))


@query(f"""WITH {_EVENTS} SELECT {_WEEKS}, count(*) AS record_count, round(avg("TEMP"), 6) AS "avg_TEMP",
    count(*) AS "n_TEMP"
  FROM e WHERE "DATE" <= {_DONE} GROUP BY year("DATE"), week("DATE")""")
def stream_weekly_upsert(spark, sf_dir):
    """Daily means as they are finished, merged file by file into the versioned weekly table."""
    means = daily.daily_stream(_records(spark, _feed(sf_dir)), ["TEMP"])
    days = shared_dir(spark, "daily")
    daily.run_available(means, days, f"{days}-checkpoint", files_per_batch=2)
    table = tables.VersionedTable(spark, shared_dir(spark, "weekly-versions"))
    finished = stream_parquet(spark, days, maxFilesPerTrigger=1)
    upsert.weekly_upsert_stream(finished, table, shared_dir(spark, "upsert-checkpoint"), ["TEMP"],
                                available_now=True).awaitTermination()
    return table.read().select(*WEEK_KEY, "record_count", F.round("avg_TEMP", 6).alias("avg_TEMP"),
                               "n_TEMP")


@query(f"""WITH {_EVENTS} SELECT CAST("DATE" AS VARCHAR) AS "DATE", count(*) AS n, sum("TEMP") AS sum_temp
  FROM e GROUP BY e."DATE" """)
def stream_archive_source(spark, sf_dir):
    """Line files in two deliveries; a file that was read moves to the archive later on."""
    feed, out = shared_dir(spark, "lines"), shared_dir(spark, "archived-rows")
    events = st.table(spark, sf_dir, "events")
    for wave in (events.filter("event_type <> 'error'"), events.filter("event_type = 'error'")):
        lines = payload.encode_payload(st.raw_events(wave))
        lines.select(F.col("value").cast("string")).write.mode("append").text(feed)
        arriving = payload.text_payload(stream_lines(spark, feed, archive_dir=f"{out}-archive"))
        rows = clean.clean_records(payload.decode_payload(arriving)).select("DATE", "TEMP")
        daily.run_available(rows, out, f"{out}-checkpoint", partition_by=())
    return (files.read_table(spark, out)
            .groupBy(F.col("DATE").cast("date").cast("string").alias("DATE"))
            .agg(F.count("*").alias("n"), F.sum("TEMP").alias("sum_temp")))


@query(f"""WITH {_EVENTS} {_DAYS} WHERE e."DATE" > {_DONE} GROUP BY e."DATE" """)
def stream_open_days(spark, sf_dir):
    """The days that the watermark has not passed yet, with what the stream has seen of them."""
    path = shared_dir(spark, "daily")
    means = daily.daily_stream(_records(spark, _feed(sf_dir)), ["TEMP"])
    daily.run_available(means, path, f"{path}-checkpoint", files_per_batch=1)
    return _days(daily.open_days(spark, f"{path}-checkpoint", ["TEMP"]))


@query(f"""WITH {_EVENTS}, first_done AS (SELECT max("DATE") - 7 AS d FROM e WHERE event_type <> 'error')
  SELECT "STATION", CAST("DATE" AS VARCHAR) AS "DATE", "TEMP", count(*) AS n FROM e, first_done
  WHERE event_type = 'error' AND "DATE" <= d GROUP BY "STATION", e."DATE", "TEMP" """)
def stream_late_rows(spark, sf_dir):
    """The rows of the errors, which arrive last, that the means do not count."""
    feed, out = shared_dir(spark, "feed"), shared_dir(spark, "late")
    events = st.table(spark, sf_dir, "events")
    for wave in (events.filter("event_type <> 'error'"), events.filter("event_type = 'error'")):
        wave.write.mode("append").parquet(feed)
        obs = clean.clean_records(payload.decode_payload(_records(spark, feed))).select("STATION", "DATE", "TEMP")
        daily.keep_late_rows(obs, out, f"{out}-checkpoint", available_now=True).awaitTermination()
    late = daily.read_late_rows(spark, out).withColumn("DATE", F.col("DATE").cast("date").cast("string"))
    return late.groupBy("STATION", "DATE", "TEMP").agg(F.count("*").alias("n"))


@query(f"""WITH {_EVENTS}, once AS (SELECT DISTINCT "STATION", "DATE", event_type, "TEMP" FROM e),
  weeks AS (SELECT CAST(date_trunc('week', "DATE") AS DATE) AS monday, count(*) AS record_count, avg("TEMP") AS "avg_TEMP" FROM once GROUP BY 1)
  SELECT CAST(monday AS VARCHAR) AS week_start, CAST(isoyear(monday) AS INTEGER) AS "Weather_Year", CAST(week(monday) AS INTEGER) AS "Weather_Week",
    record_count, "avg_TEMP" FROM weeks WHERE monday + 7 <= {_DONE}""")
def stream_weekly_window(spark, sf_dir):
    """Weekly means straight from a feed that sends every record twice: the weeks that are over."""
    feed = shared_dir(spark, "feed")
    for _ in range(2):
        st.table(spark, sf_dir, "events").write.mode("append").parquet(feed)
    weeks = _run(spark, daily.weekly_stream(_records(spark, feed), ["TEMP"]), "weeks")
    return weeks.select(F.col("week_start").cast("string").alias("week_start"), *WEEK_KEY, "record_count", "avg_TEMP")
