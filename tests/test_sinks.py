import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from miasma.functions import paths
from miasma.schema import RAW_COLUMNS
from miasma.sinks import points, tables
from miasma.sources import files
from miasma.session import shared_dir
from tests.records import raw, record

WEEKLY = "Weather_Year INT, Weather_Week INT, v DOUBLE"


def weekly(spark, *rows):
    return spark.createDataFrame(list(rows), WEEKLY)


def test_versions_replace_without_touching_their_input(spark, path):
    table = tables.VersionedTable(spark, path)
    with pytest.raises(ValueError):
        table.read()
    assert table.replace(weekly(spark, (2023, 1, 1.0), (2024, 1, 2.0))) == 0
    before = table.read()
    assert table.replace(before.withColumn("v", F.col("v") * 10)) == 1
    assert sorted(r.v for r in table.read().collect()) == [10.0, 20.0]
    assert sorted(r.v for r in before.collect()) == [1.0, 2.0]


def test_a_version_that_never_committed_is_unseen_and_replaceable(spark, path):
    table = tables.VersionedTable(spark, path)
    table.replace(weekly(spark, (2024, 1, 1.0)))
    tables.write_partitioned(weekly(spark, (2024, 9, 9.0)), table.log.path(1, "lost"))
    assert [r.v for r in table.read().collect()] == [1.0]
    table.replace(weekly(spark, (2024, 2, 5.0)))
    assert [r.v for r in table.read().collect()] == [5.0]


def test_append_new_adds_each_key_once(spark, path):
    weekly(spark, (2024, 1, 1.0)).write.parquet(path)
    more = weekly(spark, (2024, 1, 7.0), (2024, 2, 2.0))
    for _ in range(2):
        tables.append_new(more, path, ["Weather_Year", "Weather_Week"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1.0, 2.0]


def test_ledger_names_each_file_once(spark, tmp_path):
    root, ledger = str(tmp_path / "daily"), str(tmp_path / "ledger")
    tables.write_partitioned(weekly(spark, (2023, 1, 1.0)), root)
    first = files.new_files(files.list_files(spark, root), files.empty_ledger(spark))
    assert [r.year for r in files.years_of_files(first).collect()] == [2023]
    tables.append_ledger(first, ledger)
    tables.write_partitioned(weekly(spark, (2024, 1, 2.0), (2023, 2, 3.0)), root, mode="append")
    done = spark.read.parquet(ledger)
    second = files.new_files(files.list_files(spark, root), done)
    assert [r.year for r in files.years_of_files(second).collect()] == [2023, 2024]
    fresh = files.rows_of_files(spark.read.parquet(root), second)
    assert sorted(r.v for r in fresh.collect()) == [2.0, 3.0]
    tables.append_ledger(second, ledger)
    assert files.new_files(files.list_files(spark, root), spark.read.parquet(ledger)).isEmpty()


def test_ledger_takes_paths_with_blanks(spark, tmp_path):
    root = str(tmp_path / "my daily")
    tables.write_partitioned(weekly(spark, (2023, 1, 1.0)), root)
    listed = files.list_files(spark, root)
    assert files.rows_of_files(spark.read.parquet(root), listed).count() == 1


def test_one_year_scan_keeps_the_key_and_reads_one_folder(spark, path):
    tables.write_partitioned(weekly(spark, (2023, 1, 1.0), (2024, 1, 2.0)), path)
    row, = files.read_year(spark, path, 2024).collect()
    assert (row.Weather_Year, row.v) == (2024, 2.0)
    plan = files.read_table(spark, path).filter("Weather_Year = 2024")
    assert "PartitionFilters: [isnotnull(Weather_Year" in plan._jdf.queryExecution().toString()


def test_landing_by_year_and_by_station(spark, tmp_path):
    df = raw(spark, record(), record(DATE="2023-01-01"), record(STATION="99"), record(DATE="bad"))
    by_year = str(tmp_path / "a")
    tables.land_observations(df, by_year)
    assert sorted(r.year or 0 for r in spark.read.parquet(by_year).collect()) == [0, 2023, 2024, 2024]
    chosen = spark.createDataFrame([("01001099999",)], "STATION STRING")
    by_station = str(tmp_path / "b")
    tables.land_observations(df, by_station, chosen, partition_by=("STATION", "year"))
    assert (tmp_path / "b" / "STATION=01001099999" / "year=2023").is_dir()
    assert not (tmp_path / "b" / "STATION=99").exists()


def test_a_station_with_a_third_of_all_records_is_landed_by_several_tasks(spark, path):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "00").otherwise((F.col("id") % 40).cast("string")).alias("STATION"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 360).cast("int")).cast("string").alias("DATE"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.land_observations(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    landed = spark.read.parquet(path)
    per_file = [r["count"] for r in landed.groupBy("_metadata.file_path").count().collect()]
    assert sum(per_file) == 9000 and max(per_file) < 0.4 * 9000
    files_of_hot = landed.filter("STATION = '00'").select("_metadata.file_path").distinct().count()
    assert files_of_hot > 1


def test_a_tree_of_small_files_is_written_without_a_process_per_file(spark, tmp_path):
    from miasma.sinks.tree import write_csv_tree

    rows = [record(STATION=f"{i % 50:03d}", DATE=f"20{i % 7 + 10}-01-01", NAME='a "b", c' if i % 3 else None, TEMP=str(i),
                   SLP="" if i % 2 else None) for i in range(1000)]
    df, root = raw(spark, *rows), str(tmp_path / "tree")
    launched = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getThreadMXBean().getTotalStartedThreadCount
    before = launched()  # the JVM starts a thread for each process it waits for
    write_csv_tree(df, root, F.concat_ws("-", "STATION", F.substring("DATE", 1, 4)))
    assert launched() - before < 300
    assert len(list((tmp_path / "tree").rglob("*"))) == 350 * 2
    plain = str(tmp_path / "plain")
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(plain)
    tree = files.read_observation_tree(spark, root)
    assert tree.filter("NOT file_year <=> int(substring(DATE, 1, 4))").isEmpty()
    got, expected = tree.drop("file_station", "file_year"), files.read_observation_csv(spark, plain)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def bytes_shuffled(spark, run) -> int:
    """Bytes that the jobs of ``run`` write for their shuffles."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "")
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    jobs, stages = context.statusTracker(), context._jsc.sc().statusStore()
    ids = {i for job in jobs.getJobIdsForGroup(group) for i in jobs.getJobInfo(job).stageIds}
    return sum(stages.lastStageAttempt(i).shuffleWriteBytes() for i in ids)


def bytes_on_disk(folder) -> int:
    return sum(f.stat().st_blocks * 512 for f in folder.rglob("*") if f.is_file())


def test_a_tree_is_shuffled_as_narrow_rows_and_packed(spark, tmp_path):
    from miasma.sinks.tree import write_csv_tree

    table = spark.range(20_000).select("id", (F.col("id") % 40).alias("folder"))
    station = F.lpad(F.col("folder").cast("string"), 5, "0").alias("STATION")
    wide = [station, F.col("id").cast("string").alias("DATE"), *[
        F.when(F.col("id") % 3 == 0, F.lit(' a "b", c')).when(F.col("id") % 3 == 1, F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256))
        .alias(c) for c in RAW_COLUMNS[2:6]]]
    roots = [str(tmp_path / name) for name in ("plain", "packed")]
    before = bytes_shuffled(spark, lambda: write_csv_tree(table.select(wide), roots[0], F.col("STATION")))
    after = bytes_shuffled(spark, lambda: write_csv_tree(table, roots[1], station, wide, gzip=True))
    assert 0 < after < before / 3
    assert {f.name for f in (tmp_path / "packed").rglob("*.*")} == {"part.csv.gz"}
    assert bytes_on_disk(tmp_path / "packed") < bytes_on_disk(tmp_path / "plain") / 1.5
    got, expected = (spark.read.schema(table.select(wide).schema).option("header", True).option("recursiveFileLookup", True).csv(r) for r in roots)
    assert got.count() == 20_000 and got.exceptAll(expected).isEmpty()
    assert (tmp_path / "packed" / "00007").is_dir()
    assert files.read_observation_tree(spark, roots[1], "*.csv.gz").count() == files.read_observation_tree(spark, roots[0]).count() == 20_000


def test_the_tree_of_raw_records_takes_less_disk_than_its_text(spark, tmp_path, monkeypatch):
    from miasma.plans import queries_data

    days, n = [dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)], 16_000
    rows = [(i, i * 7 % 2000, i % 20, i % 7 + 1, float(i % 50 + 1), 900.0 + i * 7 % 100_000, i % 11 / 100, i % 9 / 100, "ANR"[i % 3], "FO"[i % 2],
             days[i // 20 % 2] + dt.timedelta(i % 360)) if i else (0, *[None] * 10) for i in range(n)]
    spark.createDataFrame(rows, "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                          "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries_data, "shared_dir", lambda spark, name: str(tmp_path / name))
    found = []
    shuffled = bytes_shuffled(spark, lambda: found.extend(queries_data.csv_tree_scan(spark, str(tmp_path)).collect()))
    assert sorted((r.n, r.own_station, r.file_year) for r in found if r.file_year) == [
        (399, 399, 1996), *[(400, 400, 1996)] * 19, *[(400, 400, 1997)] * 20]
    assert [(r.n, r.sum_temp) for r in found if not r.file_year] == [(1, None)]
    assert bytes_on_disk(tmp_path / "tree") < 80 * n and shuffled < 80 * n  # a record's line has 180 bytes


def test_paths(spark):
    df = spark.createDataFrame([("file:///d/Weather_Year=2024/x.parquet",), ("hdfs://h/raw/0100-2023/0100.csv",),
                                ("/in/2022/0100 copy.csv",), ("/in/x.csv",)], "p STRING")
    p = F.col("p")
    rows = df.select(paths.plain_path(p), paths.partition_value(p, "Weather_Year"),
                     paths.folder_year(p), paths.station_of_file(p)).collect()
    assert [tuple(r) for r in rows] == [
        ("/d/Weather_Year=2024/x.parquet", "2024", None, "x"),
        ("hdfs://h/raw/0100-2023/0100.csv", None, 2023, "0100"),
        ("/in/2022/0100 copy.csv", None, 2022, "0100 copy"), ("/in/x.csv", None, None, "x")]


def test_lines_are_sent_in_batches_from_the_executors(spark, tmp_path):
    target = str(tmp_path)

    def open_client():
        import os
        import uuid

        def write(lines):
            with open(os.path.join(target, uuid.uuid4().hex + ".batch"), "w") as f:
                f.write("\n".join(lines))
        return write

    lines = spark.range(0, 25, 1, 2).select(F.col("id").cast("string").alias("line"))
    points.send_lines(lines, open_client, batch_size=10)
    batches = [f.read_text().split("\n") for f in tmp_path.glob("*.batch")]
    assert sorted(len(b) for b in batches) == [2, 3, 10, 10]
    assert sorted(int(x) for b in batches for x in b) == list(range(25))
    points.write_lines(lines, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 25


def test_shared_dir_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base + "/x-") and shared_dir(spark, "x") != shared_dir(spark, "x")


def test_files_are_merged_once_even_if_a_run_dies(spark, tmp_path, monkeypatch):
    from miasma.operators.aggregate import daily_avg
    from miasma.plans import bootstrap, incremental

    store, days = bootstrap.Store(spark, str(tmp_path / "store")), str(tmp_path / "daily")

    def deliver(*rows):
        obs = spark.createDataFrame([(dt.date(2024, 1, d), t) for d, t in rows], "DATE DATE, TEMP DOUBLE")
        tables.write_partitioned(daily_avg(obs, ["TEMP"]), days, mode="append")

    def merge():
        return incremental.merge_new_files(store, days, ["TEMP"])

    deliver((1, 1.0), (2, 3.0))
    assert merge() == 0 and merge() is None
    deliver((1, 11.0))
    with monkeypatch.context() as m:
        m.setattr(tables.VersionLog, "commit", lambda *a: (_ for _ in ()).throw(IOError("lost")))
        with pytest.raises(IOError):
            merge()
    assert merge() == 1 and merge() is None
    row, = store.weekly.read().collect()
    assert (row.avg_TEMP, row.record_count) == (5.0, 3)


def test_shared_folder_is_the_checkpoint_folder_or_a_path_of_the_default_file_system(spark):
    from miasma import session

    class Hadoop:
        def __init__(self, default):
            self.default = default

        def hadoopConfiguration(self):
            return {"fs.defaultFS": self.default}

    class Unset:
        conf = {}

        def __init__(self, master, default):
            self.sparkContext = type("Context", (), {"master": master, "_jsc": Hadoop(default)})

    given = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.shared_dir(spark, "x").startswith(given + "/x-")
    for master, default in (("local[8]", "file:///"), ("spark://h:7077", "hdfs://h/")):
        assert session.shared_dir(Unset(master, default), "x").startswith("/tmp/checkpoints/x-")
    with pytest.raises(ValueError):
        session.shared_dir(Unset("spark://h:7077", "file:///"), "x")


def test_one_of_two_writers_wins_whatever_the_clocks_say(spark, path, monkeypatch):
    """Both see that version 0 is next; the one whose clock is behind commits second."""
    one, other = tables.VersionedTable(spark, path, (), ["k"]), tables.VersionedTable(spark, path, (), ["k"])
    rows = lambda v: spark.createDataFrame([(1, v)], "k int, v int")
    first, second = one.log.following(), other.log.following()
    one.write(rows(111), first)
    assert one.read().first().v == 111
    monkeypatch.setattr(tables.time, "time_ns", lambda: 0)
    with pytest.raises(tables.ConcurrentWrite):
        other.write(rows(222), second)
    assert one.read().first().v == other.read().first().v == 111
    assert other.replace(rows(333)) == 1 and one.read().first().v == 333


def test_many_writers_of_one_file(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from miasma.sinks.exclusive import publish_once

    target = str(tmp_path / "folder" / "commit.json")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: publish_once(spark, target, f"writer {i}"), range(24)))
    assert sum(made) == 1
    assert open(target).read() == f"writer {made.index(True)}"
    assert [f.name for f in (tmp_path / "folder").iterdir()] == ["commit.json"]


def test_a_second_run_reads_only_new_files(spark, tmp_path, monkeypatch):
    from miasma.operators.aggregate import daily_avg
    from miasma.plans import bootstrap, incremental

    store, days, read = bootstrap.Store(spark, str(tmp_path / "store")), str(tmp_path / "daily"), []
    plain = incremental.rows_of_new_files

    def watched(*args):
        rows = plain(*args)
        read.append(set(rows.inputFiles()))
        return rows

    monkeypatch.setattr(incremental, "rows_of_new_files", watched)
    on_disk = []
    for d in range(1, 4):
        obs = spark.createDataFrame([(dt.date(2024, 1, d), 1.0)], "DATE DATE, TEMP DOUBLE")
        tables.write_partitioned(daily_avg(obs, ["TEMP"]), days, mode="append")
        on_disk.append(set(spark.read.parquet(days).inputFiles()))
        incremental.merge_new_files(store, days, ["TEMP"])
    assert read == [on_disk[0], on_disk[1] - on_disk[0], on_disk[2] - on_disk[1]]
    monkeypatch.setattr(incremental, "MAX_NAMED_FILES", 0)
    obs = spark.createDataFrame([(dt.date(2024, 1, 9), 1.0)], "DATE DATE, TEMP DOUBLE")
    tables.write_partitioned(daily_avg(obs, ["TEMP"]), days, mode="append")
    incremental.merge_new_files(store, days, ["TEMP"])
    assert store.weekly.read().agg(F.sum("record_count")).first()[0] == 4


def test_deliveries_are_one_scan(spark, tmp_path):
    from tests.records import HEADER, line, record

    feed = tmp_path / "feed"
    feed.mkdir()
    for d in range(1, 5):
        (feed / f"{d}.csv").write_text("\n".join([line(HEADER), line(record(DATE=f"2024-01-0{d}"))]) + "\n")
        tables.land_new_files(spark, str(feed), str(tmp_path / "landing"), lambda paths: files.read_observation_csv(spark, paths))
    landed = tables.landed(spark, str(tmp_path / "landing"))
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert sorted(r.DATE for r in landed.collect()) == [f"2024-01-0{d}" for d in range(1, 5)]
    assert "version" not in landed.columns and landed.first().year == 2024


def test_of_repeated_keys_the_greatest_row_counts(spark, path):
    table = tables.VersionedTable(spark, path, (), ["k"])
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "a"), (2, None, "z")], "k int, v int, w string")
    table.upsert(rows)
    assert sorted(map(tuple, table.read().collect())) == [(1, 7, "b"), (2, None, "z")]
    table.upsert(rows.limit(2).repartition(2))
    assert sorted(map(tuple, table.read().collect())) == [(1, 7, "b"), (2, None, "z")]
