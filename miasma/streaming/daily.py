"""Daily means of a record stream, kept as a table partitioned by year."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from miasma.functions.calendar import week_year
from miasma.operators.aggregate import daily_avg, mean_by, with_means
from miasma.operators.clean import clean_records, dedupe_observations, sentinel_to_null
from miasma.schema import MEASURES, WEEK_KEY
from miasma.sources.payload import decode_payload

# Fixed value: how late a record may come.
WATERMARK_DELAY = "7 days"


def daily_stream(records: DataFrame, measures=MEASURES, keys=(), delay: str = WATERMARK_DELAY,
                 null_sentinels: bool = False, dedupe: bool = False) -> DataFrame:
    """Broker records to daily means under a watermark on ``DATE``.

    Records without a usable date go before the watermark; as a null group they would stay
    in state for ever. The state holds one row per day (and ``keys``) of the open week, not
    one per record; with ``dedupe``, which counts a station's day once, also one per
    station and day.
    """
    obs = clean_records(decode_payload(records))
    if null_sentinels:
        obs = sentinel_to_null(obs)
    obs = obs.withWatermark("DATE", delay)
    if dedupe:
        obs = dedupe_observations(obs.select("STATION", "DATE", *measures))
    return daily_avg(obs, measures, keys)


def write_stream(stream: DataFrame, path: str, checkpoint: str, partition_by=("Weather_Year",),
                 available_now: bool = False, files_per_batch: int | None = None,
                 **trigger) -> StreamingQuery:
    """Append a stream to a Parquet folder; a restart with the same checkpoint loses nothing.

    ``files_per_batch`` gathers the few finished days of a batch, which otherwise leave one
    small file per state partition.
    """
    if files_per_batch:
        stream = stream.repartition(files_per_batch)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_available(stream: DataFrame, path: str, checkpoint: str, **kwargs) -> None:
    """Process what is there, then stop."""
    write_stream(stream, path, checkpoint, available_now=True, **kwargs).awaitTermination()


def open_days(spark: SparkSession, checkpoint: str, measures=MEASURES, keys=()) -> DataFrame:
    """Daily means of the days that a stopped ``daily_stream`` still holds open: what it has seen of
    them so far, read from its state. Nothing of the stream is run or changed."""
    wanted = [*keys, *WEEK_KEY, "DATE"]
    operators = spark.read.format("state-metadata").load(checkpoint)
    for row in operators.filter(F.col("operatorName") == "stateStoreSave").collect():
        state = spark.read.format("statestore").option("operatorId", row.operatorId).load(checkpoint)
        if state.schema["key"].dataType.fieldNames() == wanted:
            break
    else:
        raise ValueError(f"no daily means in the state below {checkpoint}")
    # Buffers of the aggregate in its own order; their names in the state repeat.
    buffers = ["record_count bigint", *[f"s_{m} double" for m in measures], *[f"n_{m} bigint" for m in measures]]
    if len(state.schema["value"].dataType) != len(buffers):
        raise ValueError("the stream was run with other measures")
    held = state.select("key.*", F.col("value").cast(f"struct<{', '.join(b.replace(' ', ':') for b in buffers)}>").alias("held"))
    return with_means(held.select(*wanted, "held.*"), wanted, measures)


def late_rows(obs: DataFrame, path: str, delay_days: int = 7) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the rows a watermark of ``delay_days`` on ``DATE`` drops.

    The watermark of a batch follows from the newest ``DATE`` of the batches before it, which is kept
    beside the rows. Each batch owns a folder and a replay overwrites it, so rows are kept once.
    ``obs`` gives the columns. Read the rows with ``read_late_rows``.
    """
    columns = obs.columns

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id > 0:
            seen = spark.read.schema("newest TIMESTAMP, batch BIGINT").parquet(f"{path}/newest")
            newest = seen.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay_days} DAYS")
        late = batch.select(columns).filter(F.coalesce(F.col("DATE") <= mark, F.lit(False)))
        late.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        batch.agg(F.max("DATE").alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")

    return keep


def keep_late_rows(obs: DataFrame, path: str, checkpoint: str, delay_days: int = 7,
                   available_now: bool = False) -> StreamingQuery:
    """Run beside the stream of daily means over the same source and triggers: a table of the rows
    that the means do not count because they came too late."""
    writer = obs.writeStream.foreachBatch(late_rows(obs, path, delay_days)).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows kept by ``keep_late_rows``, with the batch they came in."""
    return spark.read.parquet(f"{path}/late")


# Columns that a record sent again repeats.
RECORD_KEY = ("STATION", "DATE", "NAME")


def weekly_stream(records: DataFrame, measures=MEASURES, delay: str = WATERMARK_DELAY, null_sentinels: bool = False,
                  record_key=RECORD_KEY) -> DataFrame:
    """Broker records to weekly means straight from the stream: (week_start, Weather_Year, Weather_Week,
    record_count, means, counts, sums), ISO year and week, once the watermark has passed a week's end.

    Two stateful steps in one query. A record that is sent again within ``delay`` counts once: its
    key is forgotten when the watermark has passed it. Then event-time windows of seven days that
    begin on Mondays. Windows count from 1970 in UTC, so the session's time zone has to be UTC.
    """
    obs = clean_records(decode_payload(records))
    if null_sentinels:
        obs = sentinel_to_null(obs)
    once = obs.withWatermark("DATE", delay).dropDuplicatesWithinWatermark([*record_key, *measures])
    # 1970-01-01 was a Thursday, the first Monday came four days later.
    weeks = mean_by(once, [F.window("DATE", "7 days", startTime="4 days").alias("week")], measures, ["week"])
    start = F.col("week.start").cast("date")
    keys = [start.alias("week_start"), week_year(start, iso=True).alias("Weather_Year"), F.weekofyear(start).cast("int").alias("Weather_Week")]
    return weeks.select(*keys, *[c for c in weeks.columns if c != "week"])
