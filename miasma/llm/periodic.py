"""Periodic runs of words: every stretch that repeats a block four times or more.

A run is a maximal stretch of words with smallest period q: words q apart are the same, and no
neighbouring word extends it. It counts if it is at least max(6, 4 q) words long.

Runs are found with a dictionary of basic factors. Level k gives equal numbers to equal factors of
L = 2^k words, built from pairs of level k - 1. Occurrences of one factor whose successor comes
within 2 L words form arithmetic progressions; their common difference is proposed as a period:

- Every period q in (L, 2 L] is met at level k (1 and 2 at level 0). A primitive block of q words has
  more than L different factors of L words, so one of them occurs once in each block, and its
  occurrences in a run of 4 q words are a progression of at least three, q apart.
- Progressions whose difference is at most L were met at a lower level already and are left out.

Two occurrences q words apart prove L pairs of equal words; from there a proposal is extended word by
word to both sides, which also tells false ones (a gap between factors that differs) from runs.
Proposals inside a stretch of their period that was found before are duplicates and skipped. Of
stretches with the same ends the smallest period counts, since a longer one there is a multiple of
it. Factors that occur once belong to no run and are dropped before the next level, so natural text
leaves little after three levels; a text of n words costs n log n at worst.

All texts of a batch are worked on at once: words are numbered per document, so no factor of two
documents is the same. Rows stand by themselves: one pass, no shuffle; memory is bounded by the batch
or by one longer text.

Defined cases: null texts have no words; texts without words or runs have zero runs and nulls for
the longest one, and keep all their words; repeated rows come out alike. Results are (id, n_words,
runs, collapsed); no other column is read or kept, so the names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.llm.common import slices, texts_of

MIN_WORDS, MIN_POWER = 6, 4
BATCH_BYTES = 4 << 20


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _extended(x: np.ndarray, start: int, end: int, q: int) -> tuple[int, int]:
    """The whole stretch of period ``q`` around ``x[start:end]``, which has it."""
    step = 16
    while end < len(x):
        same = x[end:end + step] == x[end - q:min(end + step, len(x)) - q]
        if not same.all():
            end += int(same.argmin())
            break
        end += len(same)
        step *= 2
    step = 16
    while start:
        low = max(0, start - step)
        same = (x[low:start] == x[low + q:start + q])[::-1]
        if not same.all():
            start -= int(same.argmin())
            break
        start, step = low, step * 2
    return start, end


def _progressions(at: np.ndarray, name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, end, difference) of each two neighbours in progressions of three or more occurrences of
    a factor of ``size`` words; ``at`` is sorted within equal names. Differences lie in (size, 2 size],
    for single words in [1, 2]."""
    gap = np.diff(at)
    linked = (np.diff(name) == 0) & (gap > (size if size > 1 else 0)) & (gap <= 2 * size)
    goes_on = linked[1:] & linked[:-1] & (gap[1:] == gap[:-1])
    member = np.flatnonzero(np.concatenate([goes_on, [False]]) | np.concatenate([[False], goes_on])) if len(gap) else gap
    return at[member], at[member + 1] + size, gap[member]


def _proposals(x: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What each level proposes."""
    at, name, size = np.arange(len(x)), x, 1
    where = np.empty(len(x), np.int64)
    while len(at) and (size == 1 or MIN_POWER * size < longest):
        order = np.argsort(name, kind="stable")
        at, name = at[order], name[order]
        same = np.diff(name) == 0
        repeated = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        number = np.concatenate([[0], np.cumsum(~same)])
        at, number = at[repeated], number[repeated]
        yield _progressions(at, number, size)
        # The next level: pairs of factors that follow each other, both of them repeated.
        where.fill(-1)
        where[at] = number
        back = np.sort(at)
        back = back[back + size < len(x)]
        back = back[where[back + size] >= 0]
        at, name = back, where[back] * (len(x) + 1) + where[back + size]
        size *= 2


def _stretches(x: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the stretches behind all proposals, each one once."""
    for place, end, q in _proposals(x, longest):
        order = np.lexsort((place, q))
        place, end, q = place[order], end[order], q[order]
        borders = [*np.flatnonzero(np.diff(q, prepend=-1)), len(q)]
        for low, high in zip(borders, borders[1:]):
            while low < high:
                s, e = _extended(x, int(place[low]), int(end[low]), int(q[low]))
                yield s, e, int(q[low])
                low += int(np.searchsorted(end[low:high], e, "right"))  # the rest up to there lies inside


def find_runs(x: np.ndarray, longest: int | None = None) -> list[Run]:
    """Runs of a sequence of numbers by start, then period. ``longest`` bounds the length of a run
    where the sequence is made of parts that share no number."""
    best: dict[tuple[int, int], int] = {}
    for start, end, q in _stretches(x, len(x) if longest is None else longest):
        if end - start >= max(MIN_WORDS, MIN_POWER * q):
            best[start, end] = min(q, best.get((start, end), q))
    return sorted((Run(s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r.start, r.period))


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Words of all texts in a row as numbers; no two texts share one."""
    out, used = [], 0
    for words in texts:
        known = {w: i for i, w in enumerate(dict.fromkeys(words), start=used)}
        out.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        used += len(known)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each text, given as its words."""
    sizes = [len(words) for words in texts]
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    for run in find_runs(_numbered(texts), max(sizes, default=0)):
        text = int(np.searchsorted(begin, run.start, "right")) - 1
        out[text].append(run._replace(start=run.start - int(begin[text])))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words without those that a run holds after its first period."""
    dropped = np.zeros(len(words), bool)
    for r in runs:
        dropped[r.start + r.period:r.start + r.length] = True
    return [w for w, d in zip(words, dropped.tolist()) if not d] if runs else words


def repeat_tail(key: int, words: list[bytes]) -> list[bytes]:
    """The words, of which a tail is replaced by repeats of its beginning where the number ``key``
    is divisible by ten; the number also draws where the tail begins and its period."""
    n, drawn = len(words), key // 10
    if key % 10 or not n:
        return words
    at = drawn % n
    period = 1 + (n - at) // (3 + drawn % 8)
    block = words[at:at + period]
    return (words[:at] + block * ((n - at) // period + 1))[:n]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat_by: Column | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: runs as an array of (start, length, period) by
    start, then period, and the text without the repeats, its words joined by single spaces.

    ``repeat_by`` is a column of numbers for ``repeat_tail``, null for a row to be left as it is.
    """
    key = F.lit(None) if repeat_by is None else repeat_by
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.cast("bigint").alias("key"))
    names = ["id", "n_words", "runs", "collapsed"]
    run_type = pa.list_(pa.struct([(f, pa.int64()) for f in Run._fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t.split() for t in texts_of(batch.column("text"))]
            texts = [w if k is None else repeat_tail(k, w) for k, w in zip(batch.column("key").to_pylist(), texts)]
            found = runs_of_texts(texts)
            collapsed = [b" ".join(collapse(w, r)) for w, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(w) for w in texts], pa.int64()),
                pa.array([[r._asdict() for r in f] for f in found], run_type),
                pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False)], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                                "collapsed string")


def longest(runs: Column) -> Column:
    """Of a row's runs the longest, of equal ones the first, then that of the smallest period; null if none."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"], r["length"]))
    return F.array_min(ranked)
