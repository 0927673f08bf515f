"""Nearest neighbours by int8 tiles over a grid of query groups and candidate parts.

Queries are dealt into groups that fit a worker, candidates into parts; every
group meets every part in one cell of the grid.  A cell is one task: it reads
its queries first, then its candidates as they come, and keeps the k nearest of
each query through the whole part.  A tile is a matrix product of int8 codes:
with x = s q + e (q int8, e the rounding residual) the distance of two vectors
differs from that of their quantised forms by at most |e_x| + |e_y|.  A
candidate whose lower bound exceeds the k-th best exact distance so far (at
first, the k-th smallest upper bound) can't be among the nearest.  The rest are
recomputed in double precision; the cells' results are merged by rank.  Results
are exact.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; only vectors of one length are compared; ties go to
the smaller id; a repeated id is a candidate as often as it appears, except
for the query of that id; equal query rows count once; with fewer than k candidates all are returned; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.llm.common import ship_code
from feescope.session import materialize

BLOCK_ROWS = 4096         # candidates in a tile
GROUP_BYTES = 96 << 20    # queries of a group: vectors, codes and their k nearest
PART_BYTES = 128 << 20    # vectors of a part; with the group's they are sorted in a task's memory


def usable(vector: str = "embedding") -> Column:
    """Not null, not zero, all components finite."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def vector_matrix(column: pa.Array) -> np.ndarray:
    """(n, dim) floats or doubles of a list column whose rows have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 matrix, scale, norm of the quantised rows, norm of the residuals)."""
    scale = np.abs(x).max(1) / 127
    scale = np.where(scale > 0, scale, 1)  # a denormal row: its residual is the row
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.sqrt((back * back).sum(1)), np.sqrt(((x - back) ** 2).sum(1)) * (1 + 1e-9)


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise Euclidean distance; squares are added in order of the components.

    Where the squares of finite differences overflow, they are taken of the differences over the largest one.
    """
    with np.errstate(over="ignore"):
        d = a - b
        out = np.sqrt(np.cumsum(d * d, axis=1)[:, -1])
        far = np.nonzero(np.isinf(out))[0]
        if len(far):
            top = np.abs(d[far]).max(1)
            finite = np.isfinite(top)
            far, top = far[finite], top[finite]
            d = d[far] / top[:, None]
            out[far] = top * np.sqrt(np.cumsum(d * d, axis=1)[:, -1])
    return out


def few_copies(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A tile's rows; of many copies of one vector, k rows of an id and the 2 k smallest ids' rows of them.

    They are equally far from any query, so the smallest ids are taken: k rows at most, and as many may be the query's own.
    """
    words = np.ascontiguousarray(x).view(np.uint32)
    odd = np.random.default_rng(0).integers(0, 1 << 63, words.shape[1], np.uint64) * np.uint64(2) + np.uint64(1)
    _, first, of, n = np.unique(words @ odd, return_index=True, return_inverse=True, return_counts=True)
    if n.max(initial=0) <= 2 * k or (words != words[first[of]]).any():  # few, or two vectors of one sum
        return ids, x

    def rank(key: np.ndarray) -> np.ndarray:
        start = np.concatenate([[True], key[1:] != key[:-1]])
        return np.arange(len(key)) - np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))

    order = np.lexsort((ids, of))
    change = np.cumsum(np.concatenate([[0], (np.diff(of[order]) != 0) | (np.diff(ids[order]) != 0)]))
    order = order[rank(change) < k]
    order = np.sort(order[rank(of[order]) < 2 * k])
    return ids[order], x[order]


class TileSearch:
    """The k nearest per query, fed tile by tile.

    Bounds are taken of both sides over a power of two that no component exceeds, so that no square overflows.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.near = np.full((len(ids), k), np.inf)  # by distance, then id; the worst last
        self.near_ids = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.found = np.zeros(len(ids), np.int64)  # the first so many of them are candidates
        self._quantise(float(np.abs(x).max(initial=0)))

    def _quantise(self, top: float) -> None:
        self.top = top
        self.f = 2.0 ** -min(1022, max(-1022, math.ceil(math.log2(top)))) if top > 0 else 1.0
        parts = [quantised(self.x[lo:lo + BLOCK_ROWS] * np.float64(self.f)) for lo in range(0, max(1, len(self.x)), BLOCK_ROWS)]
        self.q = [np.concatenate(v) for v in zip(*parts)]

    @property
    def heaps(self) -> list[list[tuple[float, int]]]:
        """(-distance, -id) of each query's candidates."""
        return [[(-d, -i) for d, i in zip(near[:n].tolist(), ids[:n].tolist())]
                for near, ids, n in zip(self.near, self.near_ids, self.found.tolist())]

    def add(self, ids: np.ndarray, x: np.ndarray, rows: int = 512) -> None:
        ids, x = few_copies(ids, x, self.k)
        top = float(np.abs(x).max(initial=0))
        if top * self.f > 1:
            self._quantise(max(top, self.top))
        c = quantised(x * np.float64(self.f))
        if (self.found < self.k).any():  # the first candidates set the bounds for all others
            n = max(1024, 4 * self.k)
            self._first(ids[:n], x[:n], [v[:n] for v in c], rows)
            ids, x, c = ids[n:], x[n:], [v[n:] for v in c]
        if not len(ids):
            return
        c8, cs, cn, ce = c
        # near <= a + e (a: k-th distance and the query's residual, e: the candidate's) as one product:
        # near^2 - (a + e)^2 = -2 q c + (qn^2 - a^2) + (cn^2 - e^2) - 2 a e.  Its terms sum to 2 (qn^2 + a^2 + cn^2 + e^2)
        # at most; m is twice the error that float32 sums of them can have, the last constant covers what underflows.
        dim = x.shape[1]
        m = 4 * (dim + 8) * 2.0 ** -24
        ct = np.empty((dim + 3, len(ids)), np.float32)
        np.multiply(c8.T, cs, out=ct[:dim], casting="unsafe")
        ct[dim], ct[dim + 1], ct[dim + 2] = 1, cn * cn * (1 - m) - ce * ce * (1 + m), ce
        for lo in range(0, len(self.ids), rows):
            q8, qs, qn, qe = (v[lo:lo + rows] for v in self.q)
            a = np.minimum(self.near[lo:lo + rows, -1] * self.f, 4 * math.sqrt(dim) + 4) * (1 + 1e-9) + qe
            qm = np.empty((len(qn), dim + 3), np.float32)
            np.multiply(q8, -2 * qs[:, None], out=qm[:, :dim], casting="unsafe")
            qm[:, dim], qm[:, dim + 1], qm[:, dim + 2] = qn * qn * (1 - m) - a * a * (1 + m) - 1e-33, 1, -2 * a
            at = np.flatnonzero(qm @ ct <= 0)
            self._exact(lo + at // len(ids), at % len(ids), ids, x)

    def _first(self, ids: np.ndarray, x: np.ndarray, c: list[np.ndarray], rows: int) -> None:
        c8, cs, cn, ce = c
        # products of int8 rows are whole numbers; they are exact in float32 up to 2^24
        kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
        ct = c8.astype(kind).T
        for lo in range(0, len(self.ids), rows):
            q8, qs, qn, qe = (v[lo:lo + rows] for v in self.q)
            dot = (q8.astype(kind) @ ct).astype(np.float64) * (qs[:, None] * cs[None, :])
            near = np.sqrt(np.maximum(qn[:, None] ** 2 + cn[None, :] ** 2 - 2 * dot, 0))
            # the residuals' bound, and room for the cancellation in the line above and for underflow
            err = (qe + 1e-7 * qn)[:, None] + (ce + 1e-7 * cn)[None, :] + 1e-150
            own = self.ids[lo:lo + rows, None] == ids[None, :]
            upper = np.where(own, np.inf, near + err)
            k = min(self.k, upper.shape[1]) - 1
            least = np.partition(upper, k, axis=1)[:, k] if k + 1 == self.k else np.inf
            least = np.minimum(least, self.near[lo:lo + rows, -1] * self.f * (1 + 1e-9))
            r, j = np.nonzero(near - err <= least[:, None])
            self._exact(lo + r, j, ids, x)

    def _exact(self, r: np.ndarray, j: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Pairs of a query and a candidate by their exact distances into the k nearest."""
        other = self.ids[r] != ids[j]
        r, j = r[other], j[other]
        step = max(1, (1 << 22) // x.shape[1])
        for lo in range(0, len(r), step):
            rows, i = r[lo:lo + step], ids[j[lo:lo + step]]
            d = exact_distances(self.x[rows].astype(np.float64), x[j[lo:lo + step]].astype(np.float64))
            last, last_id = self.near[rows, -1], self.near_ids[rows, -1]
            in_time = (d < last) | ((d == last) & (i <= last_id))
            self._merge(rows[in_time], d[in_time], i[in_time])

    def _merge(self, r: np.ndarray, d: np.ndarray, i: np.ndarray) -> None:
        if not len(r):
            return
        rows, of = np.unique(r, return_inverse=True)
        self.found[rows] = np.minimum(self.k, self.found[rows] + np.bincount(of))
        of = np.concatenate([np.repeat(np.arange(len(rows)), self.k), of])
        d = np.concatenate([self.near[rows].ravel(), d])
        i = np.concatenate([self.near_ids[rows].ravel(), i])
        order = np.lexsort((i, d, of))
        sizes = np.bincount(of)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        best = order[np.arange(len(order)) - first < self.k]
        self.near[rows], self.near_ids[rows] = d[best].reshape(-1, self.k), i[best].reshape(-1, self.k)

    def rows(self, at_once: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        """(query_id, vec_id, score)."""
        for lo in range(0, len(self.ids), at_once):
            found = self.found[lo:lo + at_once]
            taken = np.arange(self.k)[None, :] < found[:, None]
            if taken.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(self.ids[lo:lo + at_once], found)), pa.array(self.near_ids[lo:lo + at_once][taken]),
                     pa.array(self.near[lo:lo + at_once][taken])], names=["query_id", "vec_id", "score"])


def _search(k: int, rows_per_block: int):
    """Rows (cell, candidate, vec_id, embedding) in this order, a cell's queries before its candidates."""
    def by_length(ids: np.ndarray, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths).tolist():
            at = np.nonzero(lengths == dim)[0]
            yield dim, ids[at], vector_matrix(vectors if len(at) == len(ids) else vectors.take(pa.array(at)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, searches = None, {}, {}
        for b in batches:
            cells, sides, ids = (np.asarray(b.column(n).to_numpy(zero_copy_only=False), np.int64) for n in range(3))
            ends = np.nonzero((np.diff(cells) != 0) | (np.diff(sides) != 0))[0] + 1
            for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), len(ids)]):
                if lo == hi:
                    continue
                if cells[lo] != cell:
                    for s in searches.values():
                        yield from s.rows()
                    cell, queries, searches = cells[lo], {}, {}
                for dim, i, x in by_length(ids[lo:hi], b.column(3).slice(lo, hi - lo)):
                    if not sides[lo]:
                        queries.setdefault(dim, []).append((i, x))
                        continue
                    if dim in queries:
                        searches[dim] = TileSearch(*map(np.concatenate, zip(*queries.pop(dim))), k)
                    if dim in searches:
                        for at in range(0, len(i), rows_per_block):
                            searches[dim].add(i[at:at + rows_per_block], x[at:at + rows_per_block])
        for s in searches.values():
            yield from s.rows()
    return run


def _rows_and_components(df: DataFrame) -> tuple[int, int]:
    n = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.greatest(F.size("embedding"), F.lit(0)).cast("long")).alias("components")).first()
    return n["rows"], n["components"] or 0


def grid(query_rows: int, query_components: int, candidate_rows: int, candidate_components: int, k: int, width: int, tasks: int,
         rows_per_block: int = BLOCK_ROWS, group_bytes: int = GROUP_BYTES, part_bytes: int = PART_BYTES) -> tuple[int, int]:
    """(groups, parts): groups that fit a worker, parts that fit a task's sort; more parts if tasks lack work, of a tile at least."""
    groups = max(1, math.ceil((query_components * (width + 1) + query_rows * 16 * k) / group_bytes))
    spread = min(math.ceil(tasks / groups), math.ceil(candidate_rows / rows_per_block))
    return groups, max(1, math.ceil(candidate_components * width / part_bytes), spread)


def nearest_neighbours(queries: DataFrame, candidates: DataFrame, k: int = 10, rows_per_block: int = BLOCK_ROWS,
                       group_bytes: int = GROUP_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """The k candidates nearest to each query: query_id, rank, vec_id, score.

    Both frames have ``vec_id`` and ``embedding``; a candidate with the query's
    id is left out.  A query travels to as many cells as there are parts, a
    candidate to as many as there are groups, each as a row of its own and in its
    own width; no vector is ever in a broadcast.
    """
    spark = candidates.sparkSession
    ship_code(spark)
    both_float = all(df.schema["embedding"].dataType.elementType.typeName() == "float" for df in (queries, candidates))
    width, kind = (4, "array<float>") if both_float else (8, "array<double>")

    def rows(df: DataFrame) -> DataFrame:
        return df.where(usable() & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))

    q, c = materialize(rows(queries.select("vec_id", "embedding").distinct()), "ann-queries"), rows(candidates)
    n_q, n_c = grid(*_rows_and_components(q), *_rows_and_components(candidates), k, width, 2 * spark.sparkContext.defaultParallelism,
                    rows_per_block, group_bytes, part_bytes)
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cell = (F.col("part") * n_q + F.col("group")).cast("int").alias("cell")
    left = q.select("vec_id", "embedding", dealt(n_q).alias("group"), every(n_c).alias("part")).select(
        cell, F.lit(False).alias("candidate"), "vec_id", "embedding")
    right = c.select("vec_id", "embedding", dealt(n_c).alias("part"), every(n_q).alias("group")).select(
        cell, F.lit(True).alias("candidate"), "vec_id", "embedding")
    cells = left.unionByName(right).repartitionById(n_q * n_c, F.col("cell")).sortWithinPartitions("cell", "candidate")
    found = cells.mapInArrow(_search(k, rows_per_block), "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
