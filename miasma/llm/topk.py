"""Exact top-k search by inner product with an impact-ordered index, score at a time.

Vectors are dealt by a hash of their id into blocks of about ``BLOCK_ROWS``. A block's index has, for
each component, its members ordered by value and cut into segments of equal quantised value (about
``LEVELS``). A query weighs a component by its own value w, so a segment's impact is the most that w
times a value of the segment can be, above the least that the component can give in this block.

A query takes all segments of all components in bands of falling impact. With every band, a member
gathers the impacts of the segments it lies in. What it has gathered, plus the band's lower edge for
each component in which it was not met yet, bounds its score from above. The members that lead after
the first band are scored exactly; the k-th of them is a floor. Work ends only on proof: when few
enough members have a bound of at least the floor, all others cannot be among the k best, and those
that can are scored exactly. If the proof does not come, all segments are used up and every member
that still can be is scored.

Queries come in groups of ``QUERY_ROWS``; each group meets each block in a task of its own, so
a task holds one block and one group at any size of the table. Each gives its k best per query,
and the best of these per query are the result.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do
rows without an id; an id that several rows share stands for one vector, the least of them as
arrays are ordered; a query meets only vectors of its own number of components, never its own id;
equal scores go to the smaller id; a query with fewer than k candidates gets them all; components
are scaled and floored as doubles, and scores are exact integers (those beyond 64 bits are ranked
as doubles and given as the nearest bound). Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from miasma.llm.common import stored

BLOCK_ROWS, QUERY_ROWS = 16_384, 2_048
LEVELS = 64
BANDS = 16
RESCORE = 16
EXACT = 2.0 ** 53  # sums of whole doubles are exact below
INDEX = "dims int, block int, members int, ids binary, vectors binary, order binary, cuts binary, edges binary"


def scaled(vector: Column, factor: int = 256) -> Column:
    """Components times ``factor``, rounded down, as doubles; null for a vector that takes no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("double"))
    exact = F.transform(vector, lambda x: x.cast("double") * factor)
    fits = F.forall(exact, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # A long holds what floor gives up to 2^63; a larger double is whole already.
    whole = F.zip_with(whole, exact, lambda w, x: F.when(F.abs(x) < 2.0 ** 62, w).otherwise(x))
    return F.when(F.coalesce(fits, F.lit(False)), whole)


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector): the vectors that take part, one per id."""
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), scaled(F.col(vector_col)).alias("vector"))
    return rows.dropna().groupBy("id").agg(F.min("vector").alias("vector"))


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _matrix(rows: pa.Table, dims: int) -> np.ndarray:
    flat = rows.column("vector").combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dims)


def _packed(x: np.ndarray) -> tuple[bytes, str]:
    """The smallest type that holds whole doubles, and its letter."""
    top = np.abs(x).max(initial=0)
    kind = "h" if top < 1 << 15 else "i" if top < 1 << 31 else "d"
    return x.astype(kind).tobytes(), kind


def _unpacked(data: bytes, shape: tuple[int, int]) -> np.ndarray:
    """Kind and numbers as ``_pack`` wrote them."""
    return np.frombuffer(data, chr(data[0]), offset=8).reshape(shape).astype(float)


def _pack(x: np.ndarray) -> bytes:
    data, kind = _packed(x)
    return kind.encode().ljust(8) + data


def _segments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members by value per component; (component, begin, end) of its segments, all components in a
    row; the least and greatest value of each segment."""
    n, dims = x.shape
    order = np.empty((dims, n), np.int32)
    cuts, edges = [np.zeros((0, 3), np.int64)], [np.zeros((0, 2))]
    for j in range(dims):
        order[j] = np.argsort(x[:, j], kind="stable")
        v = x[order[j], j]
        level = np.floor(v / max(1.0, np.floor(v[-1] / LEVELS - v[0] / LEVELS)))
        ends = np.concatenate([np.flatnonzero(np.diff(level)) + 1, [n]])
        begins = np.concatenate([[0], ends[:-1]])
        cuts.append(np.stack([np.full(len(ends), j), begins + j * n, ends + j * n], 1))
        edges.append(np.stack([v[begins], v[ends - 1]], 1))
    return order, np.concatenate(cuts), np.concatenate(edges)


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index of (id, vector), a stored table with one row per block: ids, vectors, the members by
    falling order of value per component, and the segments they are cut into."""
    spark = vectors.sparkSession
    vectors = stored(vectors, "topk-vectors")
    blocks = _blocks(vectors.count(), block_rows)
    placed = vectors.select("id", "vector", F.size("vector").alias("dims"),
                            F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        dims, block = (k.as_py() for k in key)
        x, ids = _matrix(rows, dims), rows.column("id").to_numpy()
        order, cuts, edges = _segments(x)
        columns = [[dims], [block], [len(ids)], [ids.astype("q").tobytes()], [_pack(x)], [order.tobytes()],
                   [cuts.tobytes()], [edges.tobytes()]]
        return pa.table(dict(zip((c.split()[0] for c in INDEX.split(", ")), columns)), schema=_INDEX_SCHEMA)

    return stored(placed.groupBy("dims", "block").applyInArrow(build, INDEX), "topk-index")


_INDEX_SCHEMA = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.binary()) for c in INDEX.split(", ")])


class Block:
    """One block of the index, and the search in it."""

    def __init__(self, row: dict):
        n, dims = row["members"], row["dims"]
        self.ids = np.frombuffer(row["ids"], "q")
        self.x = _unpacked(row["vectors"], (n, dims))
        self.order = np.frombuffer(row["order"], np.int32)
        cuts = np.frombuffer(row["cuts"], np.int64).reshape(-1, 3)
        self.component, self.begin, self.end = cuts.T
        self.least, self.greatest = np.frombuffer(row["edges"], float).reshape(-1, 2).T
        self.dims, self.largest = dims, np.abs(self.x).max(initial=0)

    def _exact(self, members: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Inner products as whole numbers; Python's own where doubles cannot hold them."""
        if self.largest * np.abs(w).max(initial=0) * max(self.dims, 1) < EXACT:
            return (self.x[members] @ w).astype(np.int64)
        whole = [int(v) for v in w]
        return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in self.x[members].tolist()] + [None], object)[:-1]

    def _impacts(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """Impact of every segment, and the least score that the sum of impacts stands above."""
        of = w[self.component]
        low, high = of * self.least, of * self.greatest
        most, least = np.maximum(low, high), np.minimum(low, high)
        floor = np.full(self.dims, np.inf)
        np.minimum.at(floor, self.component, least)
        return most - floor[self.component], float(floor.sum())

    def top(self, query: int, w: np.ndarray, k: int) -> list[tuple[int, float, int]]:
        """The (score, score as a double, id) of the k best members but the query itself."""
        impact, base = self._impacts(w)
        bound = self._bounds(impact, base, query, w, k)
        possible = np.flatnonzero(bound)
        possible = possible[self.ids[possible] != query]
        found = [(max(-2**63, min(2**63 - 1, s)), float(s), i)
                 for s, i in zip(self._exact(possible, w).tolist(), self.ids[possible].tolist())]
        return sorted(found, key=lambda f: (-f[0], -f[1], f[2]))[:k]

    def _bounds(self, impact: np.ndarray, base: float, query: int, w: np.ndarray, k: int) -> np.ndarray:
        """Members that can be among the k best, as far as segments had to be taken to prove it of the others."""
        n = len(self.ids)
        if n <= 4 * k or not len(impact):
            return np.ones(n, bool)
        ranked = np.argsort(-impact, kind="stable")
        # One sum holds what a member has gathered and, in units of ``unit``, how often it was met.
        unit = 2.0 ** np.ceil(np.log2(impact.max() * self.dims + 2))
        tally, floor, done = np.zeros(n), -np.inf, 0
        slack = 1e-9 * (abs(base) + unit)
        size = (self.end - self.begin)[ranked]
        shares = np.searchsorted(np.cumsum(size), np.linspace(0, size.sum(), BANDS + 1)[1:], "left") + 1
        for stop in np.minimum(shares, len(ranked)):
            if stop <= done:
                continue
            band = ranked[done:stop]
            members = self.order[_spans(self.begin[band], self.end[band])]
            tally += np.bincount(members, np.repeat(impact[band] + unit, self.end[band] - self.begin[band]), n)
            done = stop
            edge = float(impact[ranked[stop]]) if stop < len(ranked) else 0.0
            met = np.floor(tally / unit)
            most = base + (tally - met * unit) + (self.dims - met) * edge
            if floor == -np.inf:
                lead = np.argpartition(-most, 4 * k)[:4 * k + 1]
                lead = lead[self.ids[lead] != query]
                floor = float(sorted(self._exact(lead, w).tolist())[-k])
            possible = most >= floor - slack
            if np.count_nonzero(possible) <= max(8 * k, n // RESCORE):
                break
        return possible


def _spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers begin … end - 1 of all spans in a row."""
    size = end - begin
    step = np.ones(size.sum(), np.int64)
    at = np.cumsum(size)[:-1]
    step[0] = begin[0]
    step[at] = begin[1:] - end[:-1] + 1
    return np.cumsum(step)


def search(index: DataFrame, queries: DataFrame, k: int = 5, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best members of ``index`` for each row of ``queries``
    (id, vector)."""
    queries = stored(queries, "topk-queries")
    groups = _blocks(queries.count(), query_rows)
    group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
    blocks = index.select("dims", "block")
    # Blocks and groups meet by equality: each query row goes to the blocks of its number of
    # components, each block to the groups.
    left = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = (queries.select("id", "vector", F.size("vector").alias("dims"), group.alias("grp"))
             .join(blocks.groupBy("dims").agg(F.collect_list("block").alias("blocks")), "dims")
             .select("id", "vector", "dims", "grp", F.explode("blocks").alias("block")))
    keys = ["dims", "block", "grp"]

    def meet(key: tuple, members: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float, int]] = []
        if members.num_rows and asked.num_rows:
            block = Block(members.to_pylist()[0])
            for query, w in zip(asked.column("id").to_pylist(), _matrix(asked, block.dims)):
                out += [(query, *f) for f in block.top(query, w, k)]
        kinds = {"query_id": pa.int64(), "score": pa.int64(), "size": pa.float64(), "vec_id": pa.int64()}
        return pa.table({n: pa.array([r[c] for r in out], t) for c, (n, t) in enumerate(kinds.items())})

    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInArrow(meet, "query_id bigint, score bigint, size double, vec_id bigint"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("size"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
