"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates and queries are dealt to a grid of bounded tiles. A tile sorts its candidates once in each
dimension. A query walks all lists from their good end (the large end where its component is
positive, the small end where it is negative), scores what it meets exactly, and stops when the sum
of the lists' current values cannot beat its kth result. The tiles' results meet in one more top-k.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Vectors and queries of a tile on average; they bound a task, whatever the table's size.
TILE_VECTORS, TILE_QUERIES = 8192, 1024
#: List entries that a query reads at a time in each dimension, growing by half while it goes on.
STEP = 32
_EXACT = float(1 << 53)


def scaled_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): v = floor(scale * x) of each component as a double. Rows without a vector, or with
    a null or non-finite component, or without an id, are left out."""
    v = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale))
    bad = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return table.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).where(~bad).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


class Lists:
    """The sorted lists of one tile."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.matrix = ids[order], matrix[order]
        self.columns = np.argsort(self.matrix, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(self.matrix.T, self.columns, axis=1)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of at least the query's k best, best first; the row whose id is own is no candidate."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        banned = np.searchsorted(self.ids, own)
        seen = np.zeros(n, bool)
        if banned < n and self.ids[banned] == own:
            seen[np.flatnonzero(self.ids == own)] = True
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, self.matrix.dtype)
        if not len(dims):
            rows = np.flatnonzero(~seen)[:k]
            return rows, np.zeros(len(rows), self.matrix.dtype)
        weight, down = query[dims], query[dims] > 0
        depth, step = 0, STEP
        while depth < n:
            end = min(n, depth + step)
            met = np.where(down[:, None], self.columns[dims, n - end : n - depth][:, ::-1], self.columns[dims, depth:end]).ravel()
            fresh = np.zeros(n, bool)
            fresh[met] = True
            fresh &= ~seen
            rows = np.flatnonzero(fresh)
            seen |= fresh
            rows, scores = np.concatenate([best_rows, rows]), np.concatenate([best, self.matrix[rows] @ query])
            if len(rows) > k:
                order = np.lexsort((self.ids[rows], -scores))[:k]
                rows, scores = rows[order], scores[order]
            best_rows, best = rows, scores
            depth, step = end, step + step // 2
            current = np.where(down, self.sorted[dims, n - end], self.sorted[dims, end - 1])
            # an unseen vector of the bound's score could still have a smaller id
            if len(best) == k and weight @ current < best[-1]:
                break
        order = np.lexsort((self.ids[best_rows], -best))
        return best_rows[order], best[order]


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows padded with zeros to the width; doubles if every product sum is exact in them, else integers."""
    vectors = vectors.combine_chunks()
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(lengths)), lengths)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, tile_vectors: int = TILE_VECTORS, tile_queries: int = TILE_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id, v array<long>) tables: each query's k best candidates by
    integer inner product but itself, all if there are fewer; ties go to the smaller vec_id.

    Vectors of unequal length count as padded with zeros. Repeated ids of candidates are separate
    candidates; a repeated query is asked once, and different vectors of one query id are ranked apart. Empty tables give no rows. Scores
    must fit in 64 bits.
    """
    vectors, asked = written(candidates, "topk-vectors"), written(queries.distinct().withColumn("q", F.monotonically_increasing_id()), "topk-queries")
    rows, cols = max(1, -(-vectors.count() // tile_vectors)), max(1, -(-asked.count() // tile_queries))
    tile = lambda n: F.pmod(F.xxhash64(F.lit("tile"), "vec_id"), F.lit(n)).cast("int")
    left = vectors.withColumn("r", tile(rows)).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    right = asked.withColumn("c", tile(cols)).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))

    def search(key: tuple, own: pa.Table, wanted: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if own.num_rows and wanted.num_rows:
            width = max(pc.max(pc.list_value_length(t["v"])).as_py() for t in (own, wanted))
            matrix, queries_ = _matrix(own["v"], width), _matrix(wanted["v"], width)
            most = float(np.abs(matrix.astype(float)).max(initial=0)) * float(np.abs(queries_.astype(float)).max(initial=0)) * width
            if most < _EXACT:
                matrix, queries_ = matrix.astype(float), queries_.astype(float)
            lists = Lists(own["vec_id"].to_numpy(), matrix)
            for q, query_id, query in zip(wanted["q"].to_pylist(), wanted["vec_id"].to_pylist(), queries_, strict=True):
                at, scores = lists.top(query, query_id, k)
                found.append((np.full(len(at), q), np.full(len(at), query_id), lists.ids[at], scores.astype(np.int64)))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table(columns, names=["q", "query_id", "vec_id", "score"])

    found = left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInArrow(search, "q long, query_id long, vec_id long, score long")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
