"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

A fingerprint's bits are majority votes over the XXH64 hashes of the text's word shingles. Equal
fingerprints collapse first (a map-side aggregate), so a group of copies of any size is one row.
Distinct fingerprints are sorted into cells by the population counts of their ``SEGMENTS`` equal
parts. Population counts that differ by more than the radius in sum mean more differing bits than
the radius, so only cells within that distance are compared; all other pairs of cells are skipped.
A cell is cut into tiles of about ``TILE`` fingerprints. A tile is held in memory and the
fingerprints of its neighbour cells stream past it in chunks, compared by numpy exclusive-or and
bit counts. No fingerprint within the radius is missed, and there is no cap on partners.

A tile reports a spanning forest of the links it finds (one link for each visitor and one for each
union of its own members), never all pairs of a group. Components come from alternating large and
small stars, each round written to the shared folder.

Work: all pairs within the radius in population counts, for four segments about 1/110 of all
pairs, so it still grows with the square of the number of distinct fingerprints; every part more
of ``segments`` skips more pairs and sends each fingerprint to more cells.

Defined cases: null and empty texts have fingerprint zero, linked like any other; fewer words than
a shingle make one shingle; rows without an id get a fingerprint and no component, link nothing
and stay in ``deduplicate``; rows that repeat an id count as one document, of which the row with
the smallest text, then the smallest other columns, stays. Input columns beside id and text are
ignored, or in ``deduplicate`` kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from miasma.llm.common import slices, stored, texts_of, unused

SEED = 42
SEGMENTS = 4
TILE = 2048
_CHUNK = 1 << 20  # pairs compared at once


def fingerprint(text: bytes, width: int = 3) -> int:
    """Signed 64-bit SimHash of UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    n = max(len(words) - width + 1, 1)
    starts = [0, *ends[:n - 1]]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[width - 1:] or ends[-1:])),
                         np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        # Sums of 255 rows fit a byte, which numpy adds up many times faster than wider numbers.
        whole = len(bits) // 255 * 255
        counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [fingerprint(t, width) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def _counts(fp: Column, segments: int) -> list[Column]:
    size = 64 // segments
    return [F.bit_count(F.call_function("shiftrightunsigned", fp, F.lit(s * size)).bitwiseAND((1 << size) - 1 if size < 64 else -1))
            for s in range(segments)]


def _cell(counts: list[Column], segments: int) -> Column:
    base = 64 // segments + 1
    cell = F.lit(0).cast("bigint")
    for c in counts:
        cell = cell * base + c
    return cell


def neighbour_steps(radius: int, segments: int) -> list[tuple[int, ...]]:
    """Differences of population counts within the radius, one of each pair of opposites."""
    return [d for d in product(range(-radius, radius + 1), repeat=segments)
            if 0 < sum(map(abs, d)) <= radius and d > (0,) * segments]


def _tiles(prints: DataFrame, radius: int, segments: int, tile: int) -> DataFrame:
    """(cell, tile, role, fp): members of a tile with role 0, those compared with it with role 1."""
    size = 64 // segments
    at = prints.select("fp", F.array(*_counts(F.col("fp"), segments)).alias("counts"))
    at = at.withColumn("cell", _cell([F.col("counts")[s] for s in range(segments)], segments))
    # At most (size + 1) ** segments rows, 83,521 for four segments, whatever the input.
    cells = at.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    cells = stored(cells, "simhash-cells")
    own = (at.join(F.broadcast(cells), "cell")
           .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")))
    home = own.select("cell", "tile", F.lit(0).alias("role"), "fp")
    # Later tiles of the same cell.
    beside = (own.filter(F.col("tile") + 1 < F.col("tiles"))
              .select("cell", F.explode(F.sequence(F.col("tile") + 1, F.col("tiles") - 1)).alias("tile"),
                      F.lit(1).alias("role"), "fp"))
    steps = F.array(*[F.array(*map(F.lit, d)) for d in neighbour_steps(radius, segments)])
    moved = at.select("fp", "counts", F.explode(steps).alias("step"))
    there = [F.col("counts")[s] + F.col("step")[s] for s in range(segments)]
    valid = F.lit(True)
    for c in there:
        valid = valid & c.between(0, size)
    visits = (moved.filter(valid).select("fp", _cell(there, segments).alias("cell"))
              .join(F.broadcast(cells), "cell")
              .select("cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
                      F.lit(1).alias("role"), "fp"))
    return home.unionByName(beside).unionByName(visits)


class _Tile:
    """Members of one tile, with the unions found so far."""

    def __init__(self, radius: int):
        self.radius, self.fp, self.parent, self.closed = radius, np.zeros(0, np.uint64), [], False

    def add(self, fp: np.ndarray) -> None:
        self.fp = np.concatenate([self.fp, fp])

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def _unite(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = self._root(i), self._root(j)
            if x != y:
                self.parent[x] = y
                yield i, j

    def _near(self, other: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(start of chunk, place in the chunk, place in the tile) of pairs within the radius."""
        step = max(_CHUNK // max(len(self.fp), 1), 1)
        for at in range(0, len(other), step):
            differ = np.bitwise_count(other[at:at + step, None] ^ self.fp[None, :])
            yield at, *np.nonzero(differ <= self.radius)

    def close(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Links between members."""
        self.closed, self.parent = True, list(range(len(self.fp)))
        found = []
        for at, i, j in self._near(self.fp):
            later = i + at > j
            pairs = list(self._unite(i[later] + at, j[later]))
            if pairs:
                a, b = np.array(pairs).T
                found.append((self.fp[a], self.fp[b]))
        return found

    def compare(self, visitors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """One link for each visitor that has any, and links between members it joins."""
        found = []
        for at, i, j in self._near(visitors):
            if len(i):
                _, first = np.unique(i, return_index=True)
                found.append((visitors[i[first] + at], self.fp[j[first]]))
                lead = np.repeat(j[first], np.diff(np.append(first, len(i))))
                both = np.unique(lead * len(self.fp) + j)
                pairs = list(self._unite(both // len(self.fp), both % len(self.fp)))
                if pairs:
                    a, b = np.array(pairs).T
                    found.append((self.fp[a], self.fp[b]))
        return found


def links(prints: DataFrame, radius: int = 2, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(u, v): links between distinct fingerprints that span all groups within the radius."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, _Tile(radius)
        for batch in batches:
            cell, number, role = (batch.column(c).to_numpy() for c in ("cell", "tile", "role"))
            fp = batch.column("fp").to_numpy().view(np.uint64)
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(number) != 0) | (np.diff(role) != 0)) + 1
            found = []
            for a, b in zip([0, *change], [*change, len(fp)]):
                if (cell[a], number[a]) != current:
                    if not held.closed:
                        found += held.close()
                    current, held = (cell[a], number[a]), _Tile(radius)
                if role[a] == 0:
                    held.add(fp[a:b])
                else:
                    if not held.closed:
                        found += held.close()
                    found += held.compare(fp[a:b])
            if found:
                yield _edges(found)
        if not held.closed and (found := held.close()):
            yield _edges(found)

    tiles = _tiles(prints, radius, segments, tile)
    return (tiles.repartition("cell", "tile").sortWithinPartitions("cell", "tile", "role")
            .mapInArrow(run, "u bigint, v bigint"))


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sides = [np.concatenate([pair[k] for pair in found]).view(np.int64) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(s) for s in sides], names=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).filter("u <> v").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(u, v): every linked vertex but the smallest of its component, with that smallest one."""
    edges, before = stored(edges.filter("u <> v").distinct(), "simhash-links"), None
    while True:
        n, total = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not n or (n, total) == before:
            return edges
        before = (n, total)
        edges = stored(_small_star(_large_star(edges)), "simhash-star")


def components(prints: DataFrame, radius: int = 2, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(id, fp, component) of every row: the smallest id that links reach. ``prints`` should be a
    stored table, for it is read several times."""
    named = prints.filter(F.col("id").isNotNull())
    distinct = stored(named.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    star = roots(links(distinct.select("fp"), radius, segments, tile))
    # Fingerprints of linked groups only; the others are their own component.
    inside = (star.select(F.col("u").alias("fp"), F.col("v").alias("root"))
              .unionByName(star.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()))
    linked = distinct.join(inside, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    linked = stored(linked.join(least, "root").select("fp", "component"), "simhash-groups")
    whole = (distinct.join(linked, "fp", "left")
             .select("fp", F.coalesce("component", "first").alias("component")))
    found = named.join(whole, "fp").select("id", "fp", "component")
    return found.unionByName(prints.filter(F.col("id").isNull()).withColumn("component", F.lit(None).cast(found.schema["component"].dataType)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 2) -> DataFrame:
    """(id, fp, component) of every row."""
    return components(stored(fingerprints(docs, id_col, text_col, width), "simhash-prints"), radius)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                radius: int = 2) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id. The list of ids that
    go is stored, so Spark knows its size when it chooses the join."""
    found = stored(near_duplicates(docs, id_col, text_col, width, radius), "simhash-components")
    key, stays, row = unused(docs, "_id", "_stays", "_row")
    ids = (found.filter(F.col("id").isNotNull()).groupBy("id")
           .agg(F.count("*").alias("n"), F.max((F.col("id") == F.col("component")).cast("int")).alias("stays")))
    gone = stored(ids.filter("stays = 0 OR n > 1").select(F.col("id").alias(key), (F.col("stays") == 1).alias(stays)), "simhash-gone")
    kept = docs.join(gone, docs[id_col] == F.col(key), "left_anti")
    repeated = gone.filter(F.col(stays))
    if not repeated.isEmpty():
        sortable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
        order = Window.partitionBy(id_col).orderBy(text_col, *[c for c in sortable if c != text_col])
        some = docs.join(repeated, docs[id_col] == F.col(key), "left_semi").withColumn(row, F.row_number().over(order))
        kept = kept.unionByName(some.filter(F.col(row) == 1).drop(row))
    return kept
