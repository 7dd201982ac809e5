"""Streams fed by files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_parquet(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    """Files of a Parquet folder as they arrive; the checkpoint remembers those seen.

    Over a streaming sink's folder the sink's commit log decides which files exist.
    """
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def stream_lines(spark: SparkSession, path: str, archive_dir: str | None = None,
                 **options) -> DataFrame:
    """Lines of text files as they arrive, as a ``value`` column. With ``archive_dir`` a file
    moves there once a later batch confirms that it was read."""
    reader = spark.readStream.options(**options)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.text(path)
