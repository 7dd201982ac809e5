"""Daily and weekly means, and merging of means that were taken apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.functions.calendar import with_week_key
from miasma.schema import MEASURES, WEEK_KEY, avg_columns, weekly_ddl


# Columns that tell rows of a weekly table apart beside the week.
KEY_COLUMNS = ("city", "STATION")


def _measure(name: str, dtype: str) -> Column:
    return F.col(name).try_cast("double") if dtype == "string" else F.col(name).cast("double")


def mean_by(df: DataFrame, keys, measures, names=None) -> DataFrame:
    """Sum and count per measure, combined before the shuffle; means are a projection on top. ``names``
    are those of the keys where a key is an expression."""
    types = dict(df.dtypes)
    sums = [F.sum(_measure(m, types[m])).alias(f"s_{m}") for m in measures]
    counts = [F.count(_measure(m, types[m])).alias(f"n_{m}") for m in measures]
    return with_means(df.groupBy(*keys).agg(F.count("*").alias("record_count"), *sums, *counts), names or keys, measures)


def with_means(grouped: DataFrame, keys, measures) -> DataFrame:
    """Means beside the sums and counts they come from; merging goes on from the sums."""
    return grouped.select(
        *keys, "record_count",
        *[F.try_divide(F.col(f"s_{m}"), F.col(f"n_{m}")).alias(f"avg_{m}") for m in measures],
        *[f"n_{m}" for m in measures], *[f"s_{m}" for m in measures])


def weekly_avg(obs: DataFrame, measures=MEASURES, keys=(), iso: bool = False) -> DataFrame:
    """Mean of each measure per week, with rows and readings per week.

    ``keys`` adds grouping columns such as the station or region.
    """
    return mean_by(with_week_key(obs, iso=iso), [*keys, *WEEK_KEY], measures)


def daily_avg(obs: DataFrame, measures=MEASURES, keys=(), iso: bool = False) -> DataFrame:
    """Mean of each measure per day, keyed by week and ``DATE``. Batch or stream."""
    return mean_by(with_week_key(obs, iso=iso), [*keys, *WEEK_KEY, "DATE"], measures)


def weighted_merge(parts: DataFrame, keys=tuple(WEEK_KEY), measures=MEASURES) -> DataFrame:
    """Means of means, each weighted by the readings behind it.

    Sums that a part carries are added up as they are. A part without sums gives its mean times
    its reading count, one without counts its non-null means times ``record_count``. A null mean
    weighs nothing. Merging is associative, so parts may arrive in any grouping.
    """
    def readings(m: str) -> Column:
        fallback = F.when(F.col(f"avg_{m}").isNull(), 0).otherwise(F.col("record_count"))
        return F.coalesce(F.col(f"n_{m}"), fallback) if f"n_{m}" in parts.columns else fallback

    def total(m: str) -> Column:
        product = F.col(f"avg_{m}") * readings(m)
        return F.coalesce(F.col(f"s_{m}"), product) if f"s_{m}" in parts.columns else product

    weighted = parts.select(
        *keys, "record_count",
        *[total(m).alias(f"s_{m}") for m in measures],
        *[readings(m).cast("bigint").alias(f"n_{m}") for m in measures])
    grouped = weighted.groupBy(*keys).agg(
        F.sum("record_count").alias("record_count"),
        *[F.sum(f"s_{m}").alias(f"s_{m}") for m in measures],
        *[F.sum(f"n_{m}").alias(f"n_{m}") for m in measures])
    return with_means(grouped, keys, measures)


def empty_weekly(spark: SparkSession, measures=MEASURES, keys=tuple(WEEK_KEY)) -> DataFrame:
    """The weekly table before anything is loaded."""
    more = ", ".join(f"{k} STRING" for k in keys if k not in WEEK_KEY)
    return spark.createDataFrame([], weekly_ddl(measures, more))


def check_keys(existing: DataFrame, incoming: DataFrame, keys) -> None:
    """Refuse a merge whose sides are not told apart by the same keys."""
    for side, df in (("table", existing), ("delivery", incoming)):
        lacking = [k for k in keys if k not in df.columns]
        beyond = [k for k in KEY_COLUMNS if k in df.columns and k not in keys]
        if lacking or beyond:
            raise ValueError(f"the {side} does not fit keys {list(keys)}: lacks {lacking}, has also {beyond}")


def weekly_upsert(existing: DataFrame, incoming: DataFrame, keys=tuple(WEEK_KEY),
                  measures=MEASURES) -> DataFrame:
    """Weekly table after merging new daily or weekly means into it.

    ``keys`` name a row of the table, the region included if it has one; both sides must fit.
    """
    check_keys(existing, incoming, keys)
    wanted = [*keys, "record_count", *avg_columns(measures),
              *[c for m in measures for c in (f"n_{m}", f"s_{m}") if c in incoming.columns]]
    both = existing.unionByName(incoming.select(wanted), allowMissingColumns=True)
    return weighted_merge(both, keys, measures)


def changed_years(incoming: DataFrame) -> DataFrame:
    """Sorted years that a delivery touches."""
    return incoming.select(F.col("Weather_Year").alias("year")).distinct().orderBy("year")
