"""Benchmark decontamination: a broadcast hash set of test n-grams against all training windows.

Every window of ``WIDTH`` words of a benchmark item goes into a table of hash, words and items. A
document becomes an array of window hashes; the array is exploded inside its row, joined with the
broadcast set by hash, and only a window that matches is cut out of the words and compared word
for word. What is shuffled is one row per document, without text, and its hits.

The set is counted first. Up to ``MAX_BROADCAST_WINDOWS`` windows are broadcast; a larger set is
dealt into blocks below that bound by its hash, and each block is broadcast to its own pass over
the documents, so the result is the same at any size. All of it is DataFrame expressions.

Defined cases: null and empty texts have no words and no hits; items without words match nothing;
an item shorter than the window is one window of its own length; items that repeat an id count
once, a null id is spelt as an empty text; rows that repeat id and text each get their own result;
in ``clean`` all columns are kept and names may clash with those of results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.llm.common import ascii_lower, stored, unused

# Words of lower-cased text: ASCII letters and digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before lower-casing.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 13
MIN_PERCENT = 5
MAX_BROADCAST_WINDOWS = 200_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column, width: int) -> Column:
    """Hashes of all windows of ``width`` words, in order."""
    n = F.size(hashes)
    starts = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(width))))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      width: int = WIDTH) -> DataFrame:
    """(key, width, window, items): distinct windows and the ids of the items that hold them."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             _words(F.col(text_col)).alias("words"))
    items = items.withColumn("width", F.least(F.size("words"), F.lit(width))).filter("width > 0")
    starts = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    cut = items.select("item", "width", F.explode(F.transform(
        starts, lambda i: F.slice("words", i, F.col("width")))).alias("window"))
    return (cut.groupBy("width", "window").agg(F.collect_set("item").alias("items"))
            .withColumn("key", F.xxhash64(_hashes(F.col("window")))))


def _hits(docs: DataFrame, windows: DataFrame, widths: list[int], first: bool) -> DataFrame:
    """(id, text_hash, n_words, start, width, items) of every verified hit; from the first block
    also one row per document with no start."""
    rows = docs.withColumn("words", _words(F.col("text")))
    rows = rows.withColumn("hashes", _hashes(F.col("words")))
    # Place 0 belongs to the row that stands for the document, then come all windows of the first
    # width, all of the second, and so on.
    keys = [F.array(F.lit(0).cast("bigint"))] if first else []
    offsets, offset = [], F.lit(int(first))
    for w in widths:
        keys.append(_windows(F.col("hashes"), w))
        offsets.append(offset)
        offset = offset + F.greatest(F.size("words") - w + 1, F.lit(0))
    rows = rows.withColumn("n_words", F.size("words").cast("bigint")).withColumn("keys", F.concat(*keys))
    # The outer form: Spark guards a plain one by a filter on the array, which it pushes below the
    # projections, where the hashes would be worked out anew for every window.
    places = rows.select("id", "text_hash", "n_words", "words", F.posexplode_outer("keys").alias("place", "key"))
    start = F.lit(None).cast("int")
    for w, o in zip(widths, offsets):
        start = F.when((F.col("width") == w) & (F.col("place") >= o)
                       & (F.col("place") < o + F.greatest(F.size("words") - w + 1, F.lit(0))), F.col("place") - o).otherwise(start)
    found = places.join(F.broadcast(windows), "key").withColumn("start", start)
    verified = (F.col("width") == 0) & (F.col("place") == 0) if first else F.lit(False)
    verified = verified | (F.col("start").isNotNull()
                           & (F.slice("words", F.col("start") + 1, F.greatest(F.col("width"), F.lit(1))) == F.col("window")))
    return found.filter(verified).select("id", "text_hash", "n_words", "start", "width", "items")


def _covered(spans: Column) -> Column:
    """Words inside any of the (start, width) spans, sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def step(a: Column, s: Column) -> Column:
        end = s["start"] + s["width"]
        return F.struct(F.greatest(end, a["end"]).alias("end"),
                        (a["n"] + F.greatest(end - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, zero, step, lambda a: a["n"])


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, text_hash, n_words, n_hit, spans, items, copies): one row per distinct id and text;
    ``spans`` are (start, width) in words, ``items`` sorted ids, ``copies`` the rows alike."""
    windows = stored(benchmark_windows(benchmark, item_col, item_text_col, width), "benchmark-windows")
    n, widths = windows.agg(F.count("*"), F.collect_set("width")).first()
    blocks, widths = max(-(-n // MAX_BROADCAST_WINDOWS), 1), sorted(widths)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    stand_in = docs.sparkSession.range(1).select(
        F.lit(0).alias("width"), F.array().cast("array<string>").alias("window"),
        F.array().cast("array<string>").alias("items"), F.lit(0).cast("bigint").alias("key"))
    found = None
    for b in range(blocks):
        block = windows.filter(F.pmod("key", F.lit(blocks)) == b)
        part = _hits(rows, stand_in.unionByName(block) if b == 0 else block, widths, b == 0)
        found = part if found is None else found.unionByName(part)
    hit = F.col("start").isNotNull()
    return (found.groupBy("id", "text_hash", "n_words")
            .agg(F.sort_array(F.collect_set(F.when(hit, F.struct("start", "width")))).alias("spans"),
                 F.collect_set(F.when(hit, F.col("items"))).alias("items"),
                 F.count(F.when(~hit, F.lit(1))).alias("copies"))
            .withColumn("items", F.sort_array(F.array_distinct(F.flatten("items"))))
            .withColumn("n_hit", _covered(F.col("spans"))))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= MIN_PERCENT * F.col("n_words"))


def report(found: DataFrame) -> DataFrame:
    """One row per document row, out of what ``scan`` gives."""
    return (found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
            .select("id", "n_words", "n_hit", "spans", "items", contaminated().alias("contaminated")))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          remove: str = "documents", **columns) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with all documents and
    without the words that were hit and what follows each up to the next word.

    The rows concerned are stored first, so Spark knows their size when it chooses the join.
    """
    found = scan(docs, benchmark, id_col, text_col, **columns)
    mine = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    key, digest, spans = unused(docs, "_id", "_hash", "_spans")
    on = [docs[id_col].eqNullSafe(F.col(key)), mine == F.col(digest)]
    if remove == "documents":
        gone = found.filter(contaminated()).select(F.col("id").alias(key), F.col("text_hash").alias(digest))
        return docs.join(stored(gone, "contaminated"), on, "left_anti")
    hits = found.filter("n_hit > 0").select(F.col("id").alias(key), F.col("text_hash").alias(digest), F.col("spans").alias(spans))
    kept = docs.join(stored(hits, "spans"), on, "left").drop(key, digest)
    return kept.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(
        without_spans(F.col(text_col), F.col(spans)))).drop(spans).select(docs.columns)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of the spans."""
    words = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    between = F.split(text, ANY_CASE_WORD, -1)
    hit = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["width"] - 1))))
    pieces = F.transform(words, lambda w, i: F.when(F.array_contains(hit, i), F.lit("")).otherwise(
        F.concat(w, F.get(between, i + 1))))
    return F.concat(F.get(between, F.lit(0)), F.array_join(pieces, ""))
