"""Exact top-k inner products with block-at-a-time pruning.

Rows are cut into ranges of ids ("blocks"). A block keeps its forward index
(the integer vectors) and, for each dimension, the largest and smallest
component. For a query the sum over dimensions of the larger of query times
maximum and query times minimum bounds every score of the block. Blocks are
taken in descending order of that sum, scored through the forward index, until
the sum falls below the query's k-th best score.

Queries and blocks meet in cells of (query chunk, row chunk), both of bounded
size; each cell returns k rows per query and a second aggregation merges them.

Defined results: a vector that is null, empty or holds a null or non-finite
component takes no part, neither as query nor as candidate; a missing trailing
component counts as 0; equal scores go to the smaller id; rows that repeat an
id are separate candidates, except that a query never meets its own id; a null
id takes no part. Components must be below 2^31 in magnitude after scaling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.shared import written

K = 5
SCALE = 256
#: Rows of a block (its bound is per block), of a row chunk and of a query chunk.
BLOCK_ROWS = 128
CHUNK_ROWS = 16_384
CHUNK_QUERIES = 2_048


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * component) of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e * scale))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of a list column as a float64 matrix, padded with zeros (exact below 2^53)."""
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lens.max(initial=0)))
    if len(lens) and (lens == width).all():
        return flat.reshape(len(lens), width).astype(np.float64)
    out = np.zeros((len(lens), width))
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in exact integers: by floats where every partial sum is below 2^53."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if largest < 2.0 ** 53:
        return a @ b.T
    return (a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T).astype(object)


def best_rows(q_ids, q, ids, rows, k: int = K, block_rows: int = BLOCK_ROWS) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the k best rows of each query, by block-at-a-time pruning.

    ``ids`` must ascend. Each round takes, for every query still open, its next
    best block; queries that share a block are scored together.
    """
    starts = np.arange(0, len(ids), block_rows)
    top = np.maximum.reduceat(rows, starts, axis=0)
    low = np.minimum.reduceat(rows, starts, axis=0)
    bound = exact_dot(np.maximum(q, 0), top) + exact_dot(np.minimum(q, 0), low)
    order = np.argsort(-bound, axis=1, kind="stable")
    exact = bound.dtype != object
    score = np.full((len(q), k), -np.inf) if exact else np.full((len(q), k), None, object)
    found = np.full((len(q), k), -1, np.int64)
    kth = np.full(len(q), -np.inf) if exact else np.array([-float("inf")] * len(q), object)
    open_ = np.arange(len(q))
    for r in range(len(starts)):
        block = order[open_, r]
        going = bound[open_, block] >= kth[open_]  # an equal bound may hold an equal score with a smaller id
        open_, block = open_[going], block[going]
        if not len(open_):
            break
        for b in np.unique(block):
            who = open_[block == b]
            lo = starts[b]
            part = exact_dot(q[who], rows[lo: lo + block_rows])
            own = ids[lo: lo + block_rows]
            new_ids = np.broadcast_to(own, part.shape)
            part = np.where(new_ids == q_ids[who][:, None], -np.inf if exact else None, part)
            all_s = np.concatenate([score[who], part], axis=1)
            all_i = np.concatenate([found[who], new_ids], axis=1)
            if exact:
                pick = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            else:
                key = [[(0, 0) if s is None else (1, s) for s in line] for line in all_s]
                pick = np.array([sorted(range(len(line)), key=lambda j, line=line, i=i: (-line[j][0], -line[j][1], i[j]))[:k] for line, i in zip(key, all_i)])
            score[who] = np.take_along_axis(all_s, pick, 1)
            found[who] = np.take_along_axis(all_i, pick, 1)
            last = score[who][:, k - 1]
            kth[who] = last if exact else np.array([-float("inf") if s is None else s for s in last], object)
    good = score > -np.inf if exact else np.array([[s is not None for s in line] for line in score]).reshape(score.shape)
    i, j = np.nonzero(good)
    return [(int(q_ids[a]), int(found[a, b]), int(score[a, b])) for a, b in zip(i, j)]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows for each query; inputs (vec_id, v)."""
    vectors, queries = written(vectors, "vectors"), written(queries, "queries")
    n_rows, n_queries = vectors.count(), queries.count()
    row_chunks, query_chunks = -(-n_rows // CHUNK_ROWS) or 1, -(-n_queries // CHUNK_QUERIES) or 1
    both = "query_id long, vec_id long, score long"

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            right = right.sort_by("vec_id")
            ids = right["vec_id"].to_numpy()
            rows = right["v"].combine_chunks()
            own = left["v"].combine_chunks()
            q = matrix(own, matrix(rows).shape[1])
            out = best_rows(left["vec_id"].to_numpy(), q, ids, matrix(rows, q.shape[1]), k)
        columns = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    def copies(df, own, n_own, other, n_other):
        """Chunk of a row, and a copy for each chunk of the other side."""
        chunk = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(own)), F.lit(n_own))
        return df.withColumn(own, chunk).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))

    left = copies(queries, "_q", query_chunks, "_r", row_chunks).groupBy("_q", "_r")
    right = copies(vectors, "_r", row_chunks, "_q", query_chunks).groupBy("_q", "_r")
    found = left.cogroup(right).applyInArrow(cell, both)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
