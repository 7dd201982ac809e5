"""Records as text lines: the form in which observations travel through a broker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.schema import DAMAGED, RAW_COLUMNS, READ_DDL


def encoded(columns=RAW_COLUMNS) -> Column:
    """A row's columns as a fully quoted CSV line, padding kept."""
    line = F.to_csv(F.struct(*columns), {
        "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return line.cast("binary")


def encode_payload(df: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """One binary ``value`` per row: its line."""
    return df.select(encoded(columns).alias("value"))


def text_payload(lines: DataFrame) -> DataFrame:
    """Lines from ``spark.read.text`` / ``readStream.text`` in the shape of broker records."""
    return lines.select(F.col("value").cast("binary").alias("value"))


def decode_payload(records: DataFrame, keep_text: bool = False) -> DataFrame:
    """Broker records to the 28 text columns; works on batch and streaming frames alike.

    A line with too few or too many fields also leaves its text in ``damaged_line``, as far as it
    goes its fields are there. ``keep_text`` adds the text of every line as ``line``.

    The parsed struct is spread by ``inline``, not by ``parsed.*``: Catalyst moves a later
    filter below a projection, where each mention of a column would parse the line again.
    """
    parsed = F.from_csv("line", READ_DDL, {"columnNameOfCorruptRecord": DAMAGED})
    lines = records.selectExpr("CAST(value AS STRING) AS line")
    return lines.select(*["line"] * keep_text, F.inline(F.array(parsed)))
