"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features of a text, each hashed into one of ``2**BITS`` weights: its lower-cased words and word
pairs, the shapes of its words (case, digits and punctuation kept, letters folded) and pairs of
shapes, and whether a word repeats the one before it. A feature's value is its share among the
n-grams of its kind, so a text of any length is scored on the same scale and whole.

Training needs a sample of labelled rows on the driver. It is bounded by rows and by bytes
(``MAX_TRAIN_ROWS``, ``MAX_TRAIN_BYTES``); scoring runs over all rows, one pass, no shuffle. The
broadcast model has a fixed size.

Defined cases: a null or empty text has no features and gets the score of the bias; labels that
are null are skipped, repeated rows count each; without any labelled row the score is 0.5, and when
none of them fits into the bound that is an error; columns named like a result are replaced; all
other columns and all rows are kept.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from miasma.llm.common import held_out, replaced, slices, stored, texts_of

BITS = 18
KINDS = 5
MAX_TRAIN_ROWS = 4_000
MAX_TRAIN_BYTES = 64 << 20
MAX_CACHED_WORDS = 400_000
FOLD = 3

# Odd multipliers for multiply-shift hashing, one per kind and one for the second of a pair.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)
_SECOND = np.uint64(0xE7037ED1A0B428DB)
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def shape(word: bytes) -> str:
    """Letter runs fold to a, A or Aa, digit runs to 0; at most 12 characters."""
    def fold(m: re.Match) -> str:
        run = m[0]
        return "A" if len(run) > 1 and run.isupper() else "Aa" if run[0].isupper() else "a"

    return _DIGITS.sub("0", _LETTERS.sub(fold, word[:64].decode("utf-8", "ignore")))[:12]


class Words(dict):
    """Word → place of its two hashes; forgotten when it grows too large."""

    def __init__(self):
        super().__init__()
        self.word, self.shape = array("Q"), array("Q")

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.word)
        self.word.append(xxhash.xxh64_intdigest(word.lower()))
        self.shape.append(xxhash.xxh64_intdigest(shape(word)))
        return place


def features(texts: list[bytes], words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind of n-gram: weight numbers of all texts in a row, and the first of each text."""
    if len(words) > MAX_CACHED_WORDS:
        words.clear()
        words.word, words.shape = array("Q"), array("Q")
    split = [t.split() for t in texts]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(s) for s in split], out=starts[1:])
    place = np.fromiter((words[w] for s in split for w in s), np.int64, starts[-1])
    word = np.array(words.word, np.uint64)[place]
    form = np.array(words.shape, np.uint64)[place]
    # Pairs must not reach over the end of a text.
    pairs = np.ones(max(len(place) - 1, 0), bool)
    inner = starts[1:-1]
    pairs[inner[(inner > 0) & (inner < len(place))] - 1] = False
    pair_starts = np.concatenate([[0], np.cumsum(np.maximum(np.diff(starts) - 1, 0))])
    down = np.uint64(64 - BITS)
    same = (word[:-1] == word[1:])[pairs].astype(np.uint64)
    yield (word * _MIX[0]) >> down, starts
    yield ((word[:-1] * _SECOND + word[1:]) * _MIX[1])[pairs] >> down, pair_starts
    yield (form * _MIX[2]) >> down, starts
    yield ((form[:-1] * _SECOND + form[1:]) * _MIX[3])[pairs] >> down, pair_starts
    yield ((same + np.uint64(1)) * _MIX[4]) >> down, pair_starts


def dot(weights: np.ndarray, texts: list[bytes], words: Words) -> np.ndarray:
    """Sparse dot product of every text with the weights, bias included."""
    out = np.full(len(texts), weights[-1])
    for numbers, starts in features(texts, words):
        counts = np.diff(starts)
        filled = counts > 0
        if filled.any():
            sums = np.add.reduceat(weights[numbers.astype(np.int64)], starts[:-1][filled])
            out[filled] += sums / counts[filled]
    return out


def fit(texts: list[bytes], labels: list[int], epochs: int = 6, alpha: float = 2.0, beta: float = 1.0,
        l1: float = 1e-4, l2: float = 1e-4) -> np.ndarray:
    """Weights by FTRL-proximal updates, one text at a time; the last weight is the bias."""
    size = (1 << BITS) + 1
    z, n, words = np.zeros(size), np.zeros(size), Words()
    rows = []
    for text in texts:
        at, value = [np.array([size - 1])], [np.array([1.0])]
        for numbers, _ in features([text], words):
            if len(numbers):
                found, count = np.unique(numbers.astype(np.int64), return_counts=True)
                at.append(found)
                value.append(count / len(numbers))
        at, value = np.concatenate(at), np.concatenate(value)
        found, back = np.unique(at, return_inverse=True)
        rows.append((found, np.bincount(back, value)))

    def weight(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i, x = rows[k]
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - labels[k]) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return weight(np.arange(size))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS,
                    max_bytes: int = MAX_TRAIN_BYTES) -> tuple[list[bytes], list[int]]:
    """Labelled texts outside the held-out third, in the order of a hash of the id, up to
    ``max_rows`` rows; of these every whole text that still fits into ``max_bytes``. The labels are
    cut first, so at most ``max_rows`` of them are broadcast to the scan of the texts."""
    by_hash = F.xxhash64(F.col("_id"))
    chosen = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
              .filter(F.col("_label").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id"), FOLD))
              .orderBy(by_hash, "_id", "_label").limit(max_rows))
    rows = stored(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
                  .join(F.broadcast(chosen), "_id").withColumn("_row", F.monotonically_increasing_id()), "quality-labelled")
    sizes = (rows.select("_id", "_label", "_row", F.octet_length("_text").alias("_bytes"), F.xxhash64("_text").alias("_hash"))
             .orderBy(by_hash, "_id", "_label", "_hash", "_row").limit(max_rows).select("_row", "_bytes").collect())
    taken, size = {}, 0
    for row, n in sizes:
        if size + n <= max_bytes:
            taken[row] = len(taken)
            size += n
    if sizes and not taken:
        raise ValueError(f"no labelled text has {max_bytes} bytes or fewer")
    found = sorted(rows.filter(F.col("_row").isin(list(taken))).select("_row", "_text", "_label").collect(), key=lambda r: taken[r[0]])
    return [r[1].encode() for r in found], [r[2] for r in found]


def train(docs: DataFrame, labels: DataFrame, **columns) -> np.ndarray:
    """Weights learned from the training sample of ``labels``."""
    texts, marks = training_sample(docs, labels, **columns)
    return fit(texts, marks) if texts else np.zeros((1 << BITS) + 1)


def classify(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """All rows and columns, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    names = ["score", "predicted"]
    schema = T.StructType([f for f in docs.schema.fields if f.name.lower() not in names]
                          + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches, text_col):
            score = 1 / (1 + np.exp(-np.clip(dot(model.value, texts_of(batch.column(text_col)), words), -700, 700)))
            yield replaced(batch, names, [pa.array(score), pa.array((score >= 0.5).astype(np.int32))])

    return docs.mapInArrow(run, schema)


def select_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score ``least`` or more, columns unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    border = np.log(least / (1 - least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(dot(model.value, texts_of(batch.column(text_col)), words) >= border))

    return docs.mapInArrow(run, docs.schema)
