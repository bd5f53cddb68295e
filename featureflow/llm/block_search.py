"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, float recomputation, merging by heaps.

Every vector is scale * code + remainder, with code in int8. A tile product of codes gives all inner products of a
block of queries and a block of candidates up to |x'||e_y| + |e_x||y|; only pairs whose upper bound reaches the k-th
best lower bound are recomputed in double precision. With true bounds no neighbour is lost. Blocks meet in rounds, long
vectors first: the k-th product of the rounds before is a floor for all later blocks, and by it and the vectors' lengths
whole pairs of blocks drop out.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.vectors import matrix, ranked, searched, usable

CELL_ROWS = 4096
QUERY_ROWS = 1024
CELL_NUMBERS = 1 << 22
TILE = 1024


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, norm of the coded vector, norm of the remainder) of each row; scales keep clear of 0."""
    scale = np.maximum(np.abs(x).max(1, initial=0) / 127, 1e-300)
    relative = x / scale[:, None]
    codes = np.rint(relative).astype(np.int8)
    return codes, scale, scale * np.sqrt((codes.astype(np.float64) ** 2).sum(1)), scale * np.sqrt(((relative - codes) ** 2).sum(1))


def norms_of(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, whose squares may be beyond doubles."""
    most = np.maximum(np.abs(x).max(1, initial=0), 1e-300)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(1))


def tile_bounds(q: tuple, c: tuple, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(approximate products, error bounds) of all pairs of a tile; `norms` are the candidates' true lengths."""
    kind = np.float32 if q[0].shape[1] <= 1000 else np.float64  # sums of codes' products are exact in it
    product = (q[0].astype(kind) @ c[0].astype(kind).T).astype(np.float64)
    product *= q[1][:, None]
    product *= c[1]
    error = q[2][:, None] * c[3] + q[3][:, None] * norms
    error += 1e-12 * ((q[2] + q[3])[:, None] * norms)  # rounding of the double sums themselves
    beyond = ~np.isfinite(product + error)  # no bound is known there
    product[beyond], error[beyond] = 0, np.inf
    return product, error


def search_cell(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k nearest candidates of the cell that reach the query's bound, tile after tile, with one heap for each query."""
    x, y = matrix(queries), matrix(candidates)
    query_ids, ids = queries["query_id"].to_numpy(), candidates["vec_id"].to_numpy()
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]  # (score, -id): the worst kept one first
    if len(x) and len(y):
        bounds = queries["bound"].fill_null(-np.inf).to_numpy()
        qx, norms = quantised(x), norms_of(y)
        for begin in range(0, len(y), TILE):
            part = slice(begin, begin + TILE)
            product, error = tile_bounds(qx, quantised(y[part]), norms[part])
            own = query_ids[:, None] == ids[part]
            product[own] = -np.inf
            lower = product - error
            width = lower.shape[1]
            floor = np.maximum(bounds, np.partition(lower, width - k, 1)[:, width - k]) if width > k else bounds
            product += error
            for row in np.flatnonzero((product >= floor[:, None]).any(1)).tolist():
                heap = heaps[row]
                least = max(floor[row], heap[0][0]) if len(heap) == k else floor[row]
                near = np.flatnonzero((product[row] >= least) & ~own[row])
                scores = np.cumsum(y[part][near] * x[row], 1)[:, -1]  # summed in order, so a pair's score is one number everywhere
                for pair in zip(scores.tolist(), (-ids[part][near]).tolist(), strict=True):
                    if len(heap) < k:
                        heapq.heappush(heap, pair)
                    elif pair > heap[0]:
                        heapq.heapreplace(heap, pair)
    found = [(q, -i, s) for q, heap in zip(query_ids.tolist(), heaps, strict=True) for s, i in heap]
    kinds = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
    return pa.table({name: pa.array([row[j] for row in found], kind) for j, (name, kind) in enumerate(kinds)})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest inner products, nearest first, ties to smaller ids.

    Rows with a null id, a null, empty or zero vector, or a null or non-finite component take no part; candidates with
    the query's id are its own; vectors meet only those of as many components; of query rows that repeat an id one is
    used; candidate rows that repeat an id are listed each. Other columns are ignored; without queries or candidates
    the result is empty. Cells of bounded size meet on (candidate group, query group); no list is longer than k a cell. A
    score is the sum of the products from the first component to the last.
    """

    def measured(found: DataFrame) -> DataFrame:
        """With the length; squares of shares of the largest component neither vanish nor overflow."""
        found = found.withColumn("most", F.array_max(F.transform("vector", F.abs)))  # a column, so that it is computed once a row
        square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("most")) * (x / F.col("most")))
        return found.withColumn("length", F.col("most") * F.sqrt(square)).drop("most")

    rows = stored(measured(usable(vectors, id_col, vector_col, zero=False)).withColumn("row", F.monotonically_increasing_id()))
    asked = usable(queries, id_col, vector_col, zero=False)
    asked = asked.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked = stored(measured(asked).withColumn("dim", F.size("vector")))
    widest = rows.agg(F.coalesce(F.max("dim"), F.lit(1))).head()[0]
    cell, size = (max(64, min(n, CELL_NUMBERS // widest)) for n in (CELL_ROWS, QUERY_ROWS))
    return ranked(searched(rows, asked, k, cell, size, lambda q, c: search_cell(q, c, k), "double"), k)
