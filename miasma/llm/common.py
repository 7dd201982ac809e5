"""What several text operators share: word rules, id buckets, stored tables, batches of texts."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.session import shared_dir

# A word is a run of anything but the six ASCII white-space characters; ``bytes.split()`` without
# arguments cuts UTF-8 text in exactly the same places.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``bytes.lower()`` does the same."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_bucket(key: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % n


def held_out(key: Column, n: int, remainder: int = 1) -> Column:
    """True for ids kept out of training. A null id is never held out."""
    return F.coalesce(id_bucket(key, n) == remainder, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder that all executors share, and read back: it is computed once,
    and a lost executor loses nothing of it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names with as many underscores before them as no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while any(n.lower() in taken for n in names):
        names = tuple(f"_{n}" for n in names)
    return list(names)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def replaced(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    """``batch`` without columns of the given names, whatever their case, and these arrays behind the rest."""
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in names]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + arrays,
                                      names=[batch.schema.names[i] for i in keep] + names)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice stay near ``max_bytes``; one longer text is a
    slice of its own."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = size = 0
        for i, n in enumerate(sizes):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
