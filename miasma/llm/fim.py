"""Fill-in-middle: texts cut in three at drawn places and put together in another order.

A text is a list of units: a run of ASCII letters, or any other single code point. Two numbers drawn
from the document's id cut it into prefix, middle and suffix. The output is ``<P>`` prefix ``<S>``
suffix ``<M>`` middle (psm), ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (spm), or the text as it is
(plain). What is drawn depends on nothing but the id.

A batch is one pipeline of ``pyarrow.compute`` calls: units as list arrays, flattened beside the row
they come from, numbered within it, filtered by role, rebuilt as lists and joined again. No Python
code runs per unit or per row. Each row stands by itself: one pass, no shuffle. A batch holds about
``BATCH_BYTES`` of text, or one text that is longer.

Defined cases: a null text is an empty one; empty texts and texts that hold a marker stay plain;
a null id is drawn as if its decimal spelling were empty; repeated rows come out alike; bytes that
are no UTF-8 count as U+FFFD. The results are (id, n, form, prefix_chars, middle_chars, output); no
other column is read or kept, so the names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.llm.common import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKER = r"<P>|<S>|<M>"
# A unit of UTF-8 bytes: letters, or one lead byte with what continues it.
UNIT = rb"([A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*)"
CUT = b"\xff"  # a byte that UTF-8 never holds
PLAIN_PERCENT, SPM_PERCENT = 10, 20
BATCH_BYTES = 2 << 20
FORMS = ["plain", "psm", "spm"]
_TEXT = pa.large_binary()


def draws(key: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    spelt = F.coalesce(key.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), spelt).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _joined(*pieces) -> pa.Array:
    return pc.binary_join_element_wise(*pieces, pa.scalar(b"", _TEXT))


def _modulo(numbers: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(numbers, pc.multiply(pc.divide(numbers, by), by))


def _units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Units of each text as lists, each with an empty unit behind, and their number without it."""
    marked = pc.replace_substring_regex(texts, UNIT, rb"\1" + CUT)
    lists = pc.split_pattern(marked, CUT)
    return lists, pc.subtract(pc.cast(pc.list_value_length(lists), pa.int64()), 1)


def _pieces(lists: pa.Array, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix: units by role, rebuilt as one list per row and joined."""
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    starts = lists.offsets.slice(0, len(lists)).cast(pa.int64())
    starts = pc.subtract(starts, starts[0])
    ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(starts, parent))
    role = pc.add(pc.cast(pc.greater_equal(ordinal, pc.take(first, parent)), pa.int8()),
                  pc.cast(pc.greater_equal(ordinal, pc.take(second, parent)), pa.int8()))
    out = []
    for r in range(3):
        chosen = pc.equal(role, pa.scalar(r, pa.int8()))
        of_row = parent.filter(chosen)
        counted = pc.value_counts(of_row)
        at = pc.index_in(pa.array(np.arange(len(lists)), parent.type), counted.field("values"))
        sizes = pc.fill_null(pc.take(counted.field("counts"), at), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)]).cast(pa.int32())
        out.append(pc.binary_join(pa.ListArray.from_arrays(offsets, units.filter(chosen)), pa.scalar(b"", _TEXT)))
    return out


def _rearranged(batch: pa.RecordBatch) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a batch of (id, text, h1 … h4)."""
    texts = batch.column("text").cast(_TEXT)
    h = [batch.column(f"h{i}") for i in range(1, 5)]
    lists, n = _units(texts)
    places = pc.add(n, 1)
    a, b = _modulo(h[0], places), _modulo(h[1], places)
    prefix, middle, suffix = _pieces(lists, pc.min_element_wise(a, b), pc.max_element_wise(a, b))
    plain = pc.or_(pc.or_(pc.equal(n, 0), pc.match_substring_regex(texts, MARKER)),
                   pc.greater_equal(_modulo(h[2], pa.scalar(100)), 100 - PLAIN_PERCENT))
    spm = pc.less(_modulo(h[3], pa.scalar(100)), SPM_PERCENT)
    form = pc.if_else(plain, FORMS[0], pc.if_else(spm, FORMS[2], FORMS[1]))
    output = pc.if_else(plain, texts, pc.if_else(
        spm, _joined(pa.scalar(SUFFIX, _TEXT), suffix, pa.scalar(PREFIX, _TEXT), prefix, pa.scalar(MIDDLE, _TEXT), middle),
        _joined(pa.scalar(PREFIX, _TEXT), prefix, pa.scalar(SUFFIX, _TEXT), suffix, pa.scalar(MIDDLE, _TEXT), middle)))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x.cast(pa.large_string())), pa.int64()))
             for x in (prefix, middle)]
    return [n, form, *chars, _as_string(output)]


def _as_string(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.large_string()).cast(pa.string())


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row. ``n`` counts units; the two
    lengths are code points, null in a plain row."""
    text = F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       *[d.alias(f"h{i}") for i, d in enumerate(draws(F.col(id_col)), start=1)])
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("id"), *_rearranged(batch)], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """Texts out of outputs: a rearranged one falls into its three pieces at the markers."""
    texts = output.cast(_TEXT)
    plain = pc.equal(form, FORMS[0])
    # A plain text may hold any number of markers; it is not taken apart.
    parts = pc.split_pattern_regex(pc.if_else(plain, pa.scalar(b"<P><S><M>", _TEXT), texts), MARKER)
    one, two, middle = (pc.list_element(parts, i) for i in (1, 2, 3))
    spm = pc.equal(form, FORMS[2])
    whole = _joined(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two))
    return _as_string(pc.if_else(plain, texts, whole))


def restore(rows: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``restored``, the text worked out of output and form alone."""
    rows = rows.select([c for c in rows.columns if c.lower() != "restored"])
    names = [*rows.columns, "restored"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output", BATCH_BYTES):
            found = _restored(batch.column("output"), batch.column("form"))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=names)

    return rows.mapInArrow(run, rows.select("*", F.lit("").alias("restored")).schema)
