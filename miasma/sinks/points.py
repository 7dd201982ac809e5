"""Sending point lines: executors write their own partitions, the driver sees no row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame


def send_lines(lines: DataFrame, open_client: Callable[[], Callable[[list[str]], None]],
               batch_size: int = 5_000) -> None:
    """Pass every ``line`` to a client in batches.

    ``open_client`` runs once per partition on the executor and returns a function that
    sends a list of lines. A retried task sends its lines again; points have a fixed time
    and tags, so a repeat overwrites itself.
    """
    def send(rows: Iterator) -> None:
        write, batch = open_client(), []
        for row in rows:
            batch.append(row.line)
            if len(batch) == batch_size:
                write(batch)
                batch = []
        if batch:
            write(batch)

    lines.select("line").foreachPartition(send)


def write_lines(lines: DataFrame, path: str) -> None:
    """Point lines as text files, ready for a bulk import."""
    lines.select("line").write.mode("append").text(path)
