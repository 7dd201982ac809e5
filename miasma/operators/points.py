"""Time-series points as text lines, one per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.functions.calendar import epoch_nanos, week_start_date


def _escaped(tag: Column) -> Column:
    """Commas, equals signs and blanks of a tag value take a backslash."""
    return F.regexp_replace(tag, r"([,= ])", r"\\$1")


def prediction_points(predictions: DataFrame, predicted: str = "prediction",
                      region: str | None = None) -> DataFrame:
    """``predicted_cases`` points: tag year, fields week and prediction, time of the week's start.

    A row without a prediction makes no point; ``without_value`` counts them.
    """
    start = week_start_date(F.col("year"), F.col("weekofyear"))
    tags = [F.lit("predicted_cases")]
    if region:
        tags.append(F.concat(F.lit("region="), _escaped(F.col(region))))
    tags.append(F.concat(F.lit("year="), F.col("year").cast("int").cast("string")))
    fields = F.concat(
        F.lit("weekofyear="), F.col("weekofyear").cast("int").cast("string"), F.lit("i,"),
        F.lit("predicted_cases="), F.col(predicted).cast("double").cast("string"))
    usable = predictions.filter(F.col(predicted).isNotNull())
    return usable.select(F.concat_ws(
        " ", F.concat_ws(",", *tags), fields, epoch_nanos(start).cast("string")).alias("line"))


def without_value(rows: DataFrame, *columns: str) -> DataFrame:
    """Number of rows that make no point because one of the columns is null, as one row."""
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in columns], F.lit(False))
    return rows.agg(F.count_if(missing).alias("left_out"))


def accuracy_points(metrics: DataFrame, run_nanos: int, keep=(), digits: int | None = None,
                    region: str | None = None) -> DataFrame:
    """``model_accuracy`` points of a metric table, stamped with the run's time.

    ``region`` names the column that tells the rows apart: as a tag, so that points of one run do
    not overwrite each other. ``keep`` names columns to carry along; ``digits`` fixes the number
    of decimals. A row without both metrics makes no point; ``without_value`` counts them.
    """
    def shown(c: str) -> Column:
        return F.format_string(f"%.{digits}f", c) if digits is not None else F.col(c).cast("string")

    fields = F.concat(F.lit("accuracy="), shown("accuracy"), F.lit(",mape="), shown("mape"))
    name = F.lit("model_accuracy")
    if region:
        name = F.concat(F.lit("model_accuracy,region="), _escaped(F.coalesce(F.col(region), F.lit("all"))))
    usable = metrics.filter(F.col("accuracy").isNotNull() & F.col("mape").isNotNull())
    return usable.select(*keep, F.concat_ws(" ", name, fields, F.lit(str(run_nanos))).alias("line"))


def percent_text(value: Column) -> Column:
    """A percentage as it is reported: two digits and a sign."""
    return F.format_string("%.2f%%", value)
