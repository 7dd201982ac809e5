"""Parquet tables that are replaced or extended while others read them."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from miasma.operators.keys import new_rows
from miasma.schema import WEEK_KEY
from miasma.sinks.exclusive import publish_once
from miasma.sources.files import list_files, new_files, read_ledger


def write_partitioned(df: DataFrame, path: str, partition_by=("Weather_Year",),
                      mode: str = "errorifexists") -> None:
    """Write with one folder per partition value and files of even size.

    The rebalance hint brings a value's rows together and splits values too large for one
    task, so a year that holds most of the data is written by many tasks.
    """
    (df.hint("rebalance", *partition_by)
     .write.mode(mode).partitionBy(*partition_by).parquet(path))


def land_observations(raw: DataFrame, path: str, stations: DataFrame | None = None,
                      partition_by=("year",), mode: str = "errorifexists") -> None:
    """Keep raw records by year, each file holding a range of stations. ``mode="append"`` adds to
    what is there.

    Range partitions make few files per year, let a station's scan skip most of them, and
    split a station that has very many records by date. ``stations`` (column STATION) limits
    the load. For a few stations ``partition_by=("STATION", "year")`` gives each its own folder.
    """
    if stations is not None:
        raw = raw.join(stations.select("STATION"), "STATION", "left_semi")
    dated = raw.withColumn("year", F.substring(F.trim("DATE"), 1, 4).try_cast("int"))
    order = [*partition_by, *[c for c in ("STATION", "DATE") if c not in partition_by]]
    (dated.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy(*partition_by).parquet(path))


def land_new_files(spark: SparkSession, source: str, path: str, read, suffix: str = ".csv",
                   partition_by=("year",)) -> int | None:
    """Land the files below ``source`` that no earlier run has landed; returns the version.

    ``read`` turns a list of paths into raw records. Each run lands in a folder of its own attempt
    and is committed with its list of files, so a run that dies is repeated as a whole and no file
    is landed twice. ``landed`` reads all that counts.
    """
    log, ledger = VersionLog(spark, path), f"{path.rstrip('/')}/_files"
    fresh = new_files(list_files(spark, source, suffix), read_ledger(spark, ledger, log.committed()))
    paths = [r.path for r in fresh.select("path").collect()]  # the files of one delivery
    if not paths:
        return None
    version, attempt = log.following(), new_attempt()
    land_observations(read(paths), log.path(version, attempt), partition_by=partition_by)
    spark.createDataFrame([(p,) for p in paths], "path STRING").write.parquet(f"{ledger}/attempt={attempt}")
    log.commit(version, attempt)
    return version


def landed(spark: SparkSession, path: str) -> DataFrame:
    """Everything that ``land_new_files`` has committed, year column included."""
    log = VersionLog(spark, path)
    paths = [log.path(r.version, r.attempt) for r in log.committed().orderBy("version").collect()]
    if not paths:
        raise ValueError(f"nothing landed yet: {path}")
    # One scan of all deliveries. Below the base path a delivery's folder reads as a column.
    return spark.read.option("basePath", log.root).parquet(*paths).drop("version")


class ConcurrentWrite(RuntimeError):
    """Another writer committed the same version first; nothing of this attempt counts."""


class VersionLog:
    """Numbered versions below a root, each attempt in a folder of its own.

    A version counts once its file in ``_versions`` exists; the file names the attempt. It is made
    exclusively (see ``publish_once``), so of two attempts at one number one wins, whatever their
    clocks say, and the other fails; neither overwrites the other's folder. Readers take the highest
    version, so a job that dies leaves the last one in force. A commit may carry the stream and
    batch it holds, so that a replay is told from news.
    """

    SCHEMA = "version BIGINT, attempt STRING, at BIGINT, stream STRING, batch BIGINT"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, version: int, attempt: str | None = None) -> str:
        """Folder of an attempt at a version, of the committed one by default."""
        if attempt is None:
            row = self.committed().filter(F.col("version") == version).first()
            attempt = row.attempt if row else None
        return f"{self.root}/version={version}-{attempt}"

    def committed(self) -> DataFrame:
        """One row per version: the attempt that counts."""
        try:
            return self.spark.read.schema(self.SCHEMA).json(f"{self.root}/_versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.SCHEMA)

    def latest(self) -> int | None:
        return self.committed().agg(F.max("version")).first()[0]

    def holds(self, stream: str, batch: int) -> bool:
        """Whether a committed version holds this batch of this stream."""
        return not self.committed().filter((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()

    def following(self) -> int:
        last = self.latest()
        return 0 if last is None else last + 1

    def latest_path(self) -> str:
        last = self.committed().agg(F.max(F.struct("version", "attempt")).alias("last")).first().last
        if last is None:
            raise ValueError(f"nothing written yet: {self.root}")
        return self.path(last.version, last.attempt)

    def commit(self, version: int, attempt: str, stream: str | None = None, batch: int | None = None) -> None:
        row = {"version": version, "attempt": attempt, "at": time.time_ns(), "stream": stream, "batch": batch}
        if not publish_once(self.spark, f"{self.root}/_versions/{version:012d}.json", json.dumps(row)):
            raise ConcurrentWrite(f"version {version} of {self.root} was committed by another writer")


def new_attempt() -> str:
    return uuid.uuid4().hex[:12]


class VersionedTable:
    """A table that is replaced as a whole, each time in a new folder; no input is overwritten.

    Meant for tables whose size the calendar bounds, such as weekly means. ``keys`` name a row;
    every step that merges rows takes them from here.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by=("Weather_Year",), keys=tuple(WEEK_KEY)):
        self.spark, self.log = spark, VersionLog(spark, root)
        self.partition_by, self.keys = list(partition_by), list(keys)

    def read(self, version: int | None = None) -> DataFrame:
        path = self.log.latest_path() if version is None else self.log.path(version)
        return self.spark.read.parquet(path)

    def write(self, df: DataFrame, version: int, attempt: str | None = None, stream: str | None = None,
              batch: int | None = None) -> None:
        """Write and commit a version; fails if another writer was first."""
        attempt = attempt or new_attempt()
        write_partitioned(df, self.log.path(version, attempt), self.partition_by)
        self.log.commit(version, attempt, stream, batch)

    def replace(self, df: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
        version = self.log.following()
        self.write(df, version, None, stream, batch)
        return version

    def upsert(self, rows: DataFrame) -> int:
        """Next version: ``rows``, and the stored rows whose key is not among them. Of rows that
        share a key the greatest counts, compared column by column."""
        rows = one_per_key(rows, self.keys)
        if self.log.latest() is None:
            return self.replace(rows)
        kept = new_rows(self.read(), rows, self.keys)
        return self.replace(rows.unionByName(kept.select(rows.columns)))


def one_per_key(df: DataFrame, keys) -> DataFrame:
    """One row per key: the greatest of those that share it, compared column by column."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("rest_")).select(*keys, "rest_.*").select(df.columns)


def append_new(incoming: DataFrame, path: str, keys) -> None:
    """Append the rows whose key the table does not hold yet, so a repeated run adds nothing.
    A key that a delivery repeats is stored once (see ``one_per_key``)."""
    spark = incoming.sparkSession
    new_rows(one_per_key(incoming, list(keys)), spark.read.parquet(path), keys).write.mode("append").parquet(path)


def append_ledger(files: DataFrame, path: str) -> None:
    """Record files as processed."""
    (files.select("path", F.current_timestamp().alias("processed_at"))
     .write.mode("append").parquet(path))
