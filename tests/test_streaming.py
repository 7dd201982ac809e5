import datetime as dt

import pytest
from pyspark.sql import functions as F

from miasma.operators import aggregate
from miasma.operators.clean import clean_records
from miasma.sinks.tables import VersionedTable
from miasma.sources import broker, payload
from miasma.sources.files import read_table
from miasma.streaming import daily, upsert
from miasma.streaming.sources import stream_lines, stream_parquet
from tests.records import HEADER, line, record


def feed(tmp_path, name, *lines):
    folder = tmp_path / "feed"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def run(spark, tmp_path, folder, **kwargs):
    records = payload.text_payload(stream_lines(spark, folder))
    out = str(tmp_path / "daily")
    means = daily.daily_stream(records, ["TEMP"], **kwargs)
    query = daily.write_stream(means, out, out + "-checkpoint", available_now=True, files_per_batch=1)
    query.awaitTermination()
    rows = read_table(spark, out, means.schema).collect()
    return {str(r.DATE.date()): (r.avg_TEMP, r.record_count) for r in rows}, query.recentProgress


def on(date, temp="1.0", station="01"):
    return line(record(DATE=date, TEMP=temp, STATION=station))


def test_days_come_out_once_the_watermark_has_passed(spark, tmp_path):
    folder = feed(tmp_path, "1.csv", line(HEADER), on("2024-01-01", "1.0"), on("2024-01-01", "3.0"))
    got, _ = run(spark, tmp_path, folder)
    assert got == {}
    feed(tmp_path, "2.csv", on("2024-01-05", "5.0"), on("2024-01-20", "7.0"))
    got, _ = run(spark, tmp_path, folder)
    assert got == {"2024-01-01": (2.0, 2), "2024-01-05": (5.0, 1)}
    feed(tmp_path, "3.csv", on("2024-01-02", "9.0"), on("2024-02-20", "1.0"))
    got, progress = run(spark, tmp_path, folder)
    assert got == {"2024-01-01": (2.0, 2), "2024-01-05": (5.0, 1), "2024-01-20": (7.0, 1)}
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) == 1


def test_finished_days_equal_the_batch_operator(spark, tmp_path):
    lines = [on(f"2024-01-{d:02d}", f"{d + s}.0", f"{s:02d}") for d in range(1, 31) for s in range(3)]
    got, _ = run(spark, tmp_path, feed(tmp_path, "1.csv", *lines, "junk", line(HEADER)))
    from miasma.operators.clean import clean_records
    batch = aggregate.daily_avg(clean_records(payload.decode_payload(
        payload.text_payload(spark.read.text(str(tmp_path / "feed"))))), ["TEMP"])
    expected = {str(r.DATE.date()): (r.avg_TEMP, r.record_count) for r in batch.collect()
                if r.DATE <= dt.datetime(2024, 1, 23)}
    assert got == expected and len(got) == 23


def test_repeated_station_days_count_once(spark, tmp_path):
    copies = [on("2024-01-01", "4.0"), on("2024-01-01", "4.0"), on("2024-01-01", "8.0", "02")]
    got, _ = run(spark, tmp_path, feed(tmp_path, "1.csv", *copies, on("2024-02-01")), dedupe=True)
    assert got == {"2024-01-01": (6.0, 2)}


def test_repeats_across_runs_count_once(spark, tmp_path):
    folder = feed(tmp_path, "1.csv", on("2024-01-01", "3.0"), on("2024-01-01", "1.0"))
    assert run(spark, tmp_path, folder, dedupe=True)[0] == {}
    feed(tmp_path, "2.csv", on("2024-01-01", "2.0"), on("2024-01-01", "5.0", "02"), on("2024-01-20", "7.0"))
    assert run(spark, tmp_path, folder, dedupe=True)[0] == {"2024-01-01": (3.0, 2)}
    feed(tmp_path, "3.csv", on("2024-01-20", "7.0"), on("2024-02-20", "1.0"))
    assert run(spark, tmp_path, folder, dedupe=True)[0] == {
        "2024-01-01": (3.0, 2), "2024-01-20": (7.0, 1)}


def test_sentinels_in_a_stream(spark, tmp_path):
    folder = feed(tmp_path, "1.csv", line(record(DATE="2024-01-01", PRCP="99.99")),
                  line(record(DATE="2024-01-01", PRCP=" 2.00")), on("2024-03-01"))
    records = payload.text_payload(stream_lines(spark, folder))
    out = str(tmp_path / "daily")
    daily.run_available(daily.daily_stream(records, ["PRCP"], null_sentinels=True), out, out + "-checkpoint")
    row, = spark.read.parquet(out).collect()
    assert (row.avg_PRCP, row.n_PRCP, row.record_count) == (2.0, 1, 2)


def parts(spark, *rows):
    return spark.createDataFrame(list(rows), "Weather_Year INT, Weather_Week INT, record_count BIGINT, "
                                             "avg_TEMP DOUBLE, n_TEMP BIGINT")


def test_weekly_table_follows_the_stream_and_survives_restarts(spark, tmp_path):
    days, checkpoint = str(tmp_path / "days"), str(tmp_path / "checkpoint")
    table = VersionedTable(spark, str(tmp_path / "weekly"))

    def drain():
        upsert.weekly_upsert_stream(stream_parquet(spark, days), table, checkpoint, ["TEMP"],
                                    available_now=True).awaitTermination()
        return {(r.Weather_Year, r.Weather_Week): (r.avg_TEMP, r.n_TEMP) for r in table.read().collect()}

    parts(spark, (2024, 1, 2, 1.0, 2)).coalesce(1).write.mode("append").parquet(days)
    assert drain() == {(2024, 1): (1.0, 2)}
    assert drain() == {(2024, 1): (1.0, 2)}
    parts(spark, (2024, 1, 2, 4.0, 1), (2023, 9, 1, None, 0)).coalesce(1).write.mode("append").parquet(days)
    assert drain() == {(2024, 1): (2.0, 3), (2023, 9): (None, 0)}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "weekly"))
    merge = upsert.upsert_batch(table, ["TEMP"])
    batch = parts(spark, (2024, 1, 2, 1.0, 2))
    for batch_id in (0, 1, 1, 1):
        merge(batch, batch_id)
    assert [(r.record_count, r.n_TEMP) for r in table.read().collect()] == [(4, 4)]


def test_read_files_move_to_the_archive(spark, tmp_path):
    archive, out = str(tmp_path / "archive"), str(tmp_path / "out")
    for name in ("1.csv", "2.csv", "3.csv"):
        folder = feed(tmp_path, name, on("2024-01-01"))
        daily.run_available(stream_lines(spark, folder, archive_dir=archive, maxFilesPerTrigger=1),
                            out, out + "-checkpoint", partition_by=())
    assert spark.read.parquet(out).count() == 3
    assert [f.name for f in (tmp_path / "archive").rglob("*.csv")]


def test_topic_options(spark, monkeypatch):
    """No broker here: what is checked is that a missing connector is the only obstacle."""
    with pytest.raises(Exception, match="(?i)kafka"):
        broker.read_topic(spark, "localhost:9092", "records")
    with pytest.raises(Exception, match="(?i)kafka"):
        broker.write_topic(spark.range(1).select(F.lit(b"x").alias("value")), "localhost:9092", "records")


def test_open_days_and_late_rows_are_tables(spark, tmp_path):
    """Three runs: what the stream still holds, and the one row that came too late, with its text fields."""
    def late(folder):
        obs = clean_records(payload.decode_payload(payload.text_payload(stream_lines(spark, folder)))).select("STATION", "DATE", "TEMP")
        daily.keep_late_rows(obs, str(tmp_path / "late"), str(tmp_path / "late-checkpoint"), available_now=True).awaitTermination()

    def held():
        state = daily.open_days(spark, str(tmp_path / "daily-checkpoint"), ["TEMP"])
        return {str(r.DATE.date()): (r.avg_TEMP, r.record_count, r.n_TEMP, r.Weather_Week) for r in state.collect()}

    folder = feed(tmp_path, "1.csv", line(HEADER), on("2024-01-01", "1.0"), on("2024-01-01", "3.0"), on("2024-01-04", "", "9"))
    run(spark, tmp_path, folder), late(folder)
    assert held() == {"2024-01-01": (2.0, 2, 2, 1), "2024-01-04": (None, 1, 0, 1)}
    feed(tmp_path, "2.csv", on("2024-01-05", "5.0"), on("2024-01-20", "7.0"))
    run(spark, tmp_path, folder), late(folder)
    assert held() == {"2024-01-20": (7.0, 1, 1, 3)}
    feed(tmp_path, "3.csv", on("2024-01-02", "9.0", "77"), on("2024-01-13", "9.0"), on("2024-02-20", "1.0"))
    _, progress = run(spark, tmp_path, folder)
    late(folder)
    kept = [(r.STATION, str(r.DATE.date()), r.TEMP) for r in daily.read_late_rows(spark, str(tmp_path / "late")).collect()]
    assert sorted(kept) == [("01", "2024-01-13", 9.0), ("77", "2024-01-02", 9.0)]
    assert sum(op["numRowsDroppedByWatermark"] for p in progress[-2:] for op in p["stateOperators"]) == 2
    with pytest.raises(ValueError):
        daily.open_days(spark, str(tmp_path / "daily-checkpoint"), ["TEMP", "PRCP"])
    # A replayed batch leaves each row there once.
    obs = spark.createDataFrame([("77", dt.datetime(2024, 1, 2), 9.0)], "STATION string, DATE timestamp, TEMP double")
    for _ in range(2):
        daily.late_rows(obs, str(tmp_path / "late"))(obs, 99)
    assert daily.read_late_rows(spark, str(tmp_path / "late")).filter("batch = 99").count() == 1


def test_weeks_come_straight_from_the_stream(spark, tmp_path):
    """Weeks begin on Mondays, also over New Year; a record that is sent again does not count."""
    out = str(tmp_path / "weeks")

    def weeks(folder):
        stream = daily.weekly_stream(payload.text_payload(stream_lines(spark, folder)), ["TEMP"])
        daily.run_available(stream, out, out + "-checkpoint")
        return {(str(r.week_start), int(r.Weather_Year), r.Weather_Week): (r.avg_TEMP, r.record_count)
                for r in read_table(spark, out, stream.schema).collect()}

    again = on("2025-01-02", "4.0")
    folder = feed(tmp_path, "1.csv", on("2024-12-29", "9.0"), on("2024-12-30", "2.0"), again, again, on("2025-01-05", "6.0", "02"), on("2025-01-06"))
    first = {("2024-12-23", 2024, 52): (9.0, 1)}
    assert weeks(folder) == first
    feed(tmp_path, "2.csv", again, on("2025-01-13", "1.0"))
    assert weeks(folder) == first | {("2024-12-30", 2025, 1): (4.0, 3)}
    feed(tmp_path, "3.csv", on("2025-01-03", "50.0", "03"), on("2025-02-20"))
    got = weeks(folder)
    assert got["2024-12-30", 2025, 1] == (4.0, 3) and got["2025-01-13", 2025, 3] == (1.0, 1) and len(got) == 4
