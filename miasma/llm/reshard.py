"""Resharding by minimum-cost flow: the transfers between shards that move the fewest bytes.

A table lies in files, and every file belongs to an old shard. From the bytes of the old shards
and the capacities of the new ones, a minimum-cost flow says how many bytes go from which old
shard to which new one: staying costs nothing, moving costs a byte for a byte. Along each old
shard (its files in order of name, cut into blocks of ``ROWS_PER_BLOCK`` rows) the flow marks
borders. Files between two borders stay or move as they are, only their shard in the layout
changes. Only files that a border cuts are rewritten: whole blocks go where their bytes lie, and
the rows of a block on a border are dealt to its targets, largest first, to the one that lacks
most. There are at most (old + new shards) borders, so at any size few files are rewritten.

The driver holds one row per file, as it does for any scan, and the flow between shards. Rows are
counted and moved by Spark; positions come from the files' own row numbers, without a shuffle.

Law ``bytes``: shards get equal shares of the bytes, to within about the smallest rows of a block.

Defined cases: a null text has size 1, as an empty one; equal texts and repeated rows are rows
like any other; an empty table gives an empty layout; all columns are kept, names may clash.
Rows must come from Parquet files.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from miasma.llm.common import stored
from miasma.session import shared_dir

ROWS_PER_BLOCK = 512


def transfers(sizes: list[int], capacities: list[int]) -> list[list[int]]:
    """Bytes from every old to every new shard, with the fewest bytes moved.

    Old shard ``i`` and new shard ``i`` are the same place. Capacities must add up to at least the
    sizes. Successive shortest paths over the residual graph: source, old, new, sink.
    """
    old, new = len(sizes), len(capacities)
    source, sink = old + new, old + new + 1
    edges: list[list[int]] = []  # to, capacity left, cost; the reverse edge is the next or last one
    around: list[list[int]] = [[] for _ in range(old + new + 2)]

    def join(a: int, b: int, room: int, cost: int) -> None:
        around[a].append(len(edges))
        edges.append([b, room, cost])
        around[b].append(len(edges))
        edges.append([a, 0, -cost])

    for i, size in enumerate(sizes):
        join(source, i, size, 0)
    for j, room in enumerate(capacities):
        join(old + j, sink, room, 0)
    between = len(edges)
    for i, size in enumerate(sizes):
        for j in range(new):
            join(i, old + j, size, int(i != j))
    while True:
        cost = [None] * len(around)
        back = [-1] * len(around)
        cost[source], queue, queued = 0, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in around[a]:
                b, room, price = edges[e]
                if room and (cost[b] is None or cost[a] + price < cost[b]):
                    cost[b], back[b] = cost[a] + price, e
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if cost[sink] is None:
            break
        path, at = [], sink
        while at != source:
            path.append(back[at])
            at = edges[back[at] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    return [[edges[between + 2 * (i * new + j) + 1][1] for j in range(new)] for i in range(old)]


def even(total: int, shards: int) -> list[int]:
    """Capacities that differ by one byte at most."""
    return [total // shards + (j < total % shards) for j in range(shards)]


@dataclass(frozen=True)
class Piece:
    """Bytes [start, end) of a file that go to one shard."""
    file: str
    start: int
    end: int
    shard: int


def cut(files: list[tuple[str, int]], old_shards: int, capacities: list[int]) -> list[Piece]:
    """Pieces of all files, out of (file, bytes) in order; file ``k`` is in shard ``k`` modulo
    ``old_shards``. What stays comes first in each shard."""
    sizes = [sum(n for _, n in files[i::old_shards]) for i in range(old_shards)]
    flow = transfers(sizes, capacities)
    pieces = []
    for i in range(old_shards):
        targets = [j for j in sorted(range(len(capacities)), key=lambda j: (j != i, j)) if flow[i][j]]
        left = {j: flow[i][j] for j in targets}
        for file, size in files[i::old_shards]:
            at = 0
            while at < size:
                j = targets[0]
                amount = min(size - at, left[j])
                pieces.append(Piece(file, at, at + amount, j))
                at += amount
                left[j] -= amount
                if not left[j]:
                    targets.pop(0)
    return pieces


def row_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint") + 1


def _file() -> Column:
    """Path of the file a row comes from, decoded, so that readers accept it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _placed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(_row_of, _file, _row): the columns in a struct, so that none clashes with the names used
    here, and the file and row they come from."""
    return docs.select(F.struct(*columns).alias("_row_of"), _file().alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _deal(block: pd.DataFrame) -> pd.DataFrame:
    """Rows of one block on a border: largest first, each to the target that lacks most."""
    lacks = dict(zip(block["targets"].iloc[0], block["shares"].iloc[0]))
    block = block.sort_values(["size", "_row"], ascending=[False, True])
    shards = []
    for size in block["size"]:
        j = max(lacks, key=lambda k: (lacks[k], -k))
        lacks[j] -= size
        shards.append(j)
    return block.assign(_shard=shards)[["_file", "_row", "_shard"]]


def reshard(docs: DataFrame, shards: int, old_shards: int, text_col: str = "text",
            capacities: list[int] | None = None) -> DataFrame:
    """The new layout, (path, shard, n_rows, moved, rewritten): one row per file. Rewritten files
    are new and lie in the shared folder; the others are the old files, untouched."""
    spark = docs.sparkSession
    sized = _placed(docs, [text_col]).select("_file", "_row", row_size(F.col("_row_of")[text_col]).alias("size"))
    block = F.floor(F.col("_row") / ROWS_PER_BLOCK)
    sizes = stored(sized.groupBy("_file", block.alias("block")).agg(F.sum("size").alias("size"), F.count("*").alias("n")),
                   "reshard-blocks")
    files = [tuple(r) for r in sizes.groupBy("_file").agg(F.sum("size"), F.sum("n")).orderBy("_file").collect()]
    layout = "path string, shard int, n_rows bigint, moved boolean, rewritten boolean"
    if not files:
        return spark.createDataFrame([], layout)
    total, rows = sum(n for _, n, _ in files), {f: n for f, _, n in files}
    home = {f: k % old_shards for k, (f, _, _) in enumerate(files)}
    pieces = cut([(f, n) for f, n, _ in files], old_shards, capacities or even(total, shards))
    by_file: dict[str, list[Piece]] = {}
    for p in pieces:
        by_file.setdefault(p.file, []).append(p)
    out = [(f, ps[0].shard, rows[f], ps[0].shard != home[f], False) for f, ps in by_file.items() if len(ps) == 1]
    severed = {f: ps for f, ps in by_file.items() if len(ps) > 1}
    if severed:
        out += _rewrite(docs, sizes, sized, severed, home)
    return spark.createDataFrame(out, layout)


def _rewrite(docs: DataFrame, sizes: DataFrame, sized: DataFrame, severed: dict[str, list[Piece]],
             home: dict[str, int]) -> list[tuple]:
    """Write the rows of cut files to new files, one folder per file's old shard and new shard."""
    spark = docs.sparkSession
    parts = spark.createDataFrame([(p.file, p.start, p.end, p.shard) for ps in severed.values() for p in ps],
                                  "_file string, start bigint, end bigint, target int")
    # Running bytes within a file: as many rows as it has blocks.
    before = Window.partitionBy("_file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = (sizes.join(F.broadcast(parts.select("_file").distinct()), "_file", "left_semi")
              .withColumn("to", F.sum("size").over(before)).withColumn("from", F.col("to") - F.col("size")))
    shares = (blocks.join(F.broadcast(parts), "_file").filter("from < end AND to > start")
              .withColumn("share", F.least("to", "end") - F.greatest("from", "start"))
              .groupBy("_file", "block").agg(F.sort_array(F.collect_list(F.struct("target", "share"))).alias("parts")))
    shares = stored(shares, "reshard-shares")
    at_block = F.floor(F.col("_row") / ROWS_PER_BLOCK)
    border = shares.filter(F.size("parts") > 1).select(
        "_file", "block", F.col("parts.target").alias("targets"), F.col("parts.share").alias("shares"))
    dealt = (sized.withColumn("block", at_block).join(border, ["_file", "block"])
             .groupBy("_file", "block").applyInPandas(_deal, "_file string, _row bigint, _shard int"))
    dealt = stored(dealt, "reshard-dealt")
    whole = (shares.filter(F.size("parts") == 1)
             .select("_file", F.col("block").alias("_block"), F.col("parts")[0]["target"].alias("_whole")))
    cut_docs = _placed(spark.read.schema(docs.schema).parquet(*severed), docs.columns).withColumn("_block", at_block)
    # At most ROWS_PER_BLOCK rows for each border, and one row per cut file.
    placed = (cut_docs.join(whole, ["_file", "_block"], "left").join(F.broadcast(dealt), ["_file", "_row"], "left")
              .withColumn("_shard", F.coalesce("_whole", "_shard")))
    known = spark.createDataFrame([(f, home[f]) for f in severed], "_file string, _home int")
    root, folder = shared_dir(spark, "resharded"), "_from_to"
    (placed.join(F.broadcast(known), "_file").select("_row_of.*", F.concat_ws("-", "_home", "_shard").alias(folder))
     .write.partitionBy(folder).parquet(root))
    written = spark.read.schema(docs.schema).parquet(root).select(_file().alias("path"))
    out = []
    for path, n in written.groupBy("path").count().collect():
        old, new = map(int, path.rpartition(f"/{folder}=")[2].split("/")[0].split("-"))
        out.append((path, new, n, old != new, True))
    return out


def read_layout(docs: DataFrame, layout: DataFrame) -> DataFrame:
    """All rows of the new layout with ``_shard`` and ``_slot``, the place in the shard, gapless
    from 0. ``docs`` gives the columns."""
    spark = docs.sparkSession
    files = [tuple(r) for r in layout.select("path", "shard", "n_rows").orderBy("shard", "path").collect()]
    starts, seen = [], {}
    for path, shard, n in files:
        starts.append((path, shard, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + n
    if not files:
        return docs.select("*", F.lit(0).alias("_shard"), F.lit(0).cast("bigint").alias("_slot")).limit(0)
    known = spark.createDataFrame(starts, "_file string, _shard int, _start bigint")
    rows = _placed(spark.read.schema(docs.schema).parquet(*[path for path, _, _ in files]), docs.columns)
    # One row per file, which the driver lists for any scan; without the hint all texts would be
    # shuffled, for Spark does not know how short the list is.
    return rows.join(F.broadcast(known), "_file").select("_row_of.*", "_shard", (F.col("_start") + F.col("_row")).alias("_slot"))
