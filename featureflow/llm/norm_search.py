"""Exact top-k by inner product, norm-bucketed: long vectors first, pruning by length or by coordinates, then products.

Candidates are grouped by length. A query's k best among ever more cells, the longest vectors first, give a bound that
its final list cannot fall below; with it, whole buckets, short vectors of a bucket, or vectors whose direction is too
far off in the query's largest coordinates are left out, and what remains is verified by its product. Nothing is
approximate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.vectors import SLACK, first_k, matrix, ranked, searched, usable

#: Candidates and queries of a cell; numbers of a cell's matrix at most.
CELL_ROWS = 4096
QUERY_ROWS = 1024
CELL_NUMBERS = 1 << 22
#: From this cosine on, a bucket is pruned by coordinates instead of length; coordinates looked at.
COORDINATE_COSINE = 0.5
FOCUS = 4


def survivors(query: np.ndarray, length: float, bound: float, unit: np.ndarray, lengths: np.ndarray) -> np.ndarray | slice:
    """Candidates (lengths descending) that may reach `bound`; a bound of 0 or less excludes nothing."""
    if bound <= 0 or not len(lengths):
        return slice(None)
    if length == 0 or lengths[0] == 0:
        return slice(0)
    cosine = bound / (length * lengths[0]) * (1 - SLACK)
    if cosine > 1:
        return slice(0)
    if cosine < COORDINATE_COSINE:
        return slice(int(np.searchsorted(-lengths, -bound / length * (1 - SLACK), "right")))
    direction = query / length
    focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
    own = direction[focus]
    centre = own * cosine
    reach = np.sqrt(np.maximum((1 - own**2) * (1 - cosine**2), 0)) + 1e-7
    # the cone around the direction reaches the axis itself where the direction is that close to it
    high = np.where(own >= cosine - 1e-7, np.inf, centre + reach)
    low = np.where(own <= 1e-7 - cosine, -np.inf, centre - reach)
    return np.flatnonzero(((unit[:, focus] >= low) & (unit[:, focus] <= high)).all(1))


def search_cell(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of the cell for each query that can still reach the query's bound."""
    if not queries.num_rows or not candidates.num_rows:
        return _table([], [], [])
    q, c = matrix(queries), matrix(candidates)
    ids, lengths = candidates["vec_id"].to_numpy(), candidates["length"].to_numpy()
    order = np.lexsort((ids, -lengths))
    c, ids, lengths = c[order], ids[order], lengths[order]
    if float(np.abs(c).max()) * float(np.abs(q).max()) * c.shape[1] < 2**53:
        c, q = c.astype(np.float64), q.astype(np.float64)  # exact there, and the faster product
    unit = c / np.maximum(lengths, 1e-300)[:, None]
    out_q, out_v, out_s = [], [], []
    bounds = queries["bound"].fill_null(np.iinfo(np.int64).min).to_numpy()
    for row, (query_id, length, bound) in enumerate(zip(queries["query_id"].to_pylist(), queries["length"].to_pylist(), bounds.tolist(), strict=True)):
        near = survivors(q[row], length, bound, unit, lengths)
        scores, own = (c[near] @ q[row]).astype(np.int64), ids[near]
        use = np.flatnonzero((own != query_id) & (scores >= bound))
        best = use[first_k(scores[use], own[use], k)]
        out_q.append(np.full(len(best), query_id, np.int64))
        out_v.append(own[best])
        out_s.append(scores[best])
    return _table(out_q, out_v, out_s)


def _table(*columns: list[np.ndarray]) -> pa.Table:
    return pa.table({n: np.concatenate(x) if x else np.zeros(0, np.int64) for n, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products, ties to smaller ids.

    Components are whole numbers. Rows with a null id, a null or empty vector, or a null or non-finite component take
    no part; candidates with the query's id are its own; vectors meet only those of as many components; of query rows
    that repeat an id one is used; candidate rows that repeat an id are listed each. Zero vectors take part, with
    score 0. Other columns are ignored; without queries or candidates the result is empty. Scores must fit 63 bits.
    """

    def prepared(rows: DataFrame) -> DataFrame:
        square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
        return usable(rows, id_col, vector_col, zero=True).select("vec_id", "dim", F.col("vector").cast("array<long>").alias("vector"), F.sqrt(square).alias("length"))

    rows = stored(prepared(vectors).withColumn("row", F.monotonically_increasing_id()))
    asked = prepared(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("vector", "dim", "length")).alias("q"))
    asked = stored(asked.select("query_id", "q.dim", "q.vector", "q.length"))
    widest, longest = rows.agg(F.coalesce(F.max("dim"), F.lit(1)), F.coalesce(F.max("length"), F.lit(0.0))).head()
    if longest * asked.agg(F.coalesce(F.max("length"), F.lit(0.0))).head()[0] >= 2**63:
        raise ValueError("vectors so long that scores may exceed 63 bits")
    cell, size = (max(64, min(n, CELL_NUMBERS // widest)) for n in (CELL_ROWS, QUERY_ROWS))
    return ranked(searched(rows, asked, k, cell, size, lambda q, c: search_cell(q, c, k), "long"), k)


def integers(column: str, factor: int = 64) -> Column:
    """floor(factor * x) of each component, computed in double precision; null and non-finite components stay as they are."""
    return F.transform(F.col(column).cast("array<double>"), lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.floor(x * F.lit(float(factor))).cast("double")))
