"""Batch scans. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from miasma.functions.paths import folder_year, partition_value, plain_path, station_of_file
from miasma.schema import CASES_DDL, DAMAGED, LEDGER_DDL, READ_DDL


def read_observation_csv(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """Station-day CSV files as text columns. ``path`` may be a folder, a glob or a list. A line with
    too few or too many fields leaves its text in ``damaged_line``.

    The parser looks at all fields of a line whichever columns are asked for: else it would not see
    how many there are. Its buffer is made anew for each file and is therefore small; longer lines pass
    through it in pieces.
    """
    reader = (spark.read.schema(READ_DDL).option("header", True).option("columnNameOfCorruptRecord", DAMAGED)
              .option("columnPruning", False).option("inputBufferSize", 1 << 14)
              .option("enforceSchema", True).option("recursiveFileLookup", True))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def read_observation_tree(spark: SparkSession, path, glob: str = "*.csv") -> DataFrame:
    """Station-day CSV files with the station and year that their path states. Gzipped ones are read
    with ``glob="*.csv.gz"``."""
    file = F.col("_metadata.file_path")
    return read_observation_csv(spark, path, glob).select(
        "*", station_of_file(file).alias("file_station"), folder_year(file).alias("file_year"))


def read_cases_csv(spark: SparkSession, path) -> DataFrame:
    """Weekly case counts. Padded numbers are taken; lines that do not fit, such as repeated
    headers, go."""
    fields = StructType.fromDDL(CASES_DDL).fields
    text = ", ".join(f"{f.name} STRING" for f in fields)
    raw = spark.read.schema(text).option("header", True).csv(path)
    return raw.select([F.trim(f.name).try_cast(f.dataType).alias(f.name) for f in fields]).dropna()


def read_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """One year's folder of a table partitioned by ``Weather_Year``, key column included."""
    return (spark.read.option("basePath", root).parquet(f"{root}/Weather_Year={year}")
            .withColumn("Weather_Year", F.col("Weather_Year").cast("int")))


def read_table(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """A whole table, partition columns included. Reading the root keeps a streaming
    sink's commit log in force, so files of an unfinished batch stay unseen. ``schema`` is
    needed where the table may still be empty."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(root)


def list_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """Files below ``root`` as (path, modificationTime, length), paths spelt as in
    ``_metadata``. No file is opened."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
            .load(root)
            .select(plain_path(F.col("_metadata.file_path")).alias("path"),
                    "modificationTime", "length"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_DDL)


def read_ledger(spark: SparkSession, path: str, committed: DataFrame) -> DataFrame:
    """Files merged by the committed versions, of a ledger kept as one folder per attempt."""
    try:
        rows = spark.read.schema("path STRING, attempt STRING").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_ledger(spark)
    return rows.join(committed.select("attempt"), "attempt", "left_semi")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that no earlier run has recorded."""
    return listing.join(ledger.select("path"), "path", "left_anti")


def rows_of_files(table: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of ``table`` that come from the given files."""
    tagged = table.withColumn("path", plain_path(F.col("_metadata.file_path")))
    return tagged.join(files.select("path"), "path", "left_semi").drop("path")


def read_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Exactly these files of a table, partition columns included. Nothing else is listed or read."""
    return spark.read.option("basePath", root).parquet(*paths)


def years_of_files(files: DataFrame) -> DataFrame:
    """Sorted distinct years of partitioned files: the years a load has changed."""
    return (files.select(partition_value(F.col("path"), "Weather_Year").cast("int").alias("year"))
            .dropna().distinct().orderBy("year"))
