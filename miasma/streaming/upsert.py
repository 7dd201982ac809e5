"""Merging a stream of daily means into the versioned weekly table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from miasma.operators.aggregate import empty_weekly, weekly_upsert
from miasma.schema import MEASURES
from miasma.sinks.tables import VersionedTable


def upsert_batch(table: VersionedTable, measures=MEASURES, stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. Each batch makes the next version of the table, whoever wrote
    the ones before, and is committed under (stream, batch number): a replay finds that pair and
    does nothing. ``stream`` must differ between streams that feed one table."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        if table.log.holds(stream, batch_id):
            return
        last = table.log.latest()
        existing = empty_weekly(batch.sparkSession, measures, table.keys) if last is None else table.read(last)
        merged = weekly_upsert(existing, batch, table.keys, measures)
        table.write(merged, 0 if last is None else last + 1, None, stream, batch_id)

    return merge


def weekly_upsert_stream(daily: DataFrame, table: VersionedTable, checkpoint: str,
                         measures=MEASURES, available_now: bool = False) -> StreamingQuery:
    """Keep the weekly table up to date with a stream of daily means.

    The checkpoint remembers which files were merged; each one counts once. Its path names the
    stream, so a stream with a new checkpoint starts anew beside what the table holds.
    """
    writer = (daily.writeStream.foreachBatch(upsert_batch(table, measures, checkpoint.rstrip("/")))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
