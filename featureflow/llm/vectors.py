"""What both vector searches share: usable vectors, rounds over grids of bounded cells, the merge of partial lists."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import stored

#: Buckets of candidates by length, and bands of queries by the length that they ask for.
BUCKETS = 16
#: A round has that many times the cells of all rounds before it.
GROWTH = 16
#: Lengths and scores are sums in double precision: a bound gives way by this share.
SLACK = 1e-9


def usable(rows: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(vec_id, dim, vector as doubles) of the rows with an id and finite components; all-zero vectors only if `zero`."""
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).where(~bad)
    if not zero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    return rows.select("vec_id", F.size("vector").alias("dim"), "vector")


def groups(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _above(column: str, borders: list[float]) -> Column:
    """How many of the borders are above the column."""
    return F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b > F.col(column))) if borders else F.lit(0)


def _borders(rows: DataFrame, column: str) -> list[float]:
    return sorted(set(rows.approxQuantile(column, [i / BUCKETS for i in range(1, BUCKETS)], 0.001)))


def _at(values: list[int], place: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.col(place) + 1)


def rounds(cells: list[int]) -> list[list[tuple[int, int]]]:
    """(first, end) of the cells of each bucket for each round, ever more of all; the longest bucket is one round ahead."""
    out, ends = [], [0, 0, 1]
    while ends[-2] < cells[0] or any(ends[-3] < c for c in cells[1:]):
        out.append([(min(x, c), min(y, c)) for c, x, y in zip(cells, [ends[-2], *[ends[-3]] * len(cells)], [ends[-1], *[ends[-2]] * len(cells)], strict=False)])
        ends.append(ends[-1] * GROWTH)
    return out


def searched(rows: DataFrame, asked: DataFrame, k: int, cell: int, size: int, search: Callable[[pa.Table, pa.Table], pa.Table], kind: str) -> DataFrame:
    """query_id, vec_id, score: at most k best rows a query and round, all of a query's k best among them.

    `rows` (vec_id, dim, vector, length, row) lie in buckets by length, longest first, cut into cells of about `cell` rows
    by a hash of `row`; `asked` (query_id, dim, vector, length) in bands by the least length that may still enter their
    lists, cut into parts of about `size`. After each round a query's k-th score is its bound, so that later cells
    return what may enter the list, not k rows each, and cells that no query of a band can reach are not sent
    there. Only one row a bucket and band comes to the driver; the plan does not grow with the rows.
    """
    borders = _borders(rows, "length")
    rows = rows.withColumn("bucket", _above("length", borders))
    known = {r["bucket"]: r for r in rows.groupBy("bucket").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()}
    if not known:
        return asked.sparkSession.createDataFrame([], f"query_id long, vec_id long, score {kind}")
    named = {b: i for i, b in enumerate(sorted(known))}  # without empty buckets
    cells, longest = [groups(known[b]["n"], cell) for b in named], [known[b]["longest"] for b in named]
    rows = rows.withColumn("bucket", _at([named.get(b, 0) for b in range(len(borders) + 1)], "bucket"))
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("row"), _at(cells, "bucket")).cast("int"))
    best = None
    for own in rounds(cells):
        found = _round(rows, _bounded(asked, best, k, kind), own, longest, size, search, kind)
        best = stored(found if best is None else ranked(best.unionByName(found), k).drop("rank"))
    return best


def _bounded(asked: DataFrame, best: DataFrame | None, k: int, kind: str) -> DataFrame:
    """`asked` with its bound, the k-th score so far (else null), and the least length that reaches it (else 0)."""
    if best is None:
        return asked.select("*", F.lit(None).cast(kind).alias("bound"), F.lit(0.0).alias("need"))
    bound = best.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))  # it never has more than k
    need = F.when((F.col("bound") > 0) & (F.col("length") > 0), F.col("bound") / F.col("length") * (1 - SLACK)).otherwise(0.0)
    return stored(asked.join(bound, "query_id", "left").withColumn("need", need))


def _round(rows: DataFrame, asked: DataFrame, own: list[tuple[int, int]], longest: list[float], size: int, search: Callable, kind: str) -> DataFrame:
    borders = _borders(asked, "need")
    asked = asked.withColumn("band", F.lit(len(borders)) - _above("need", borders))
    bands = {r["band"]: r for r in asked.groupBy("band").agg(F.count("*").alias("n"), F.min("need").alias("need")).collect()}
    parts = [groups(bands[b]["n"], size) if b in bands else 0 for b in range(len(borders) + 1)]
    ends = list(accumulate(parts))
    share = F.pmod(F.xxhash64("query_id", F.lit(2)), F.greatest(_at(parts, "band"), F.lit(1))).cast("int")
    asked = asked.withColumn("part", _at([e - p for e, p in zip(ends, parts, strict=True)], "band") + share)
    # bands ascend, so the parts that a bucket's longest vector is long enough for are the first ones
    reach = [max((ends[b] for b in bands if bands[b]["need"] <= far), default=0) for far in longest]
    begins, stops = ([x[i] for x in own] for i in (0, 1))
    here = (F.col("sub") >= _at(begins, "bucket")) & (F.col("sub") < _at(stops, "bucket")) & (_at(reach, "bucket") > 0)
    spread = rows.where(here).withColumn("part", F.explode(F.sequence(F.lit(0), _at(reach, "bucket") - 1)))
    places = F.array(*(F.struct(F.lit(b).alias("bucket"), F.lit(x).alias("begin"), F.lit(y).alias("end"), F.lit(float(far)).alias("far")) for b, ((x, y), far) in enumerate(zip(own, longest, strict=True)) if x < y))
    left = asked.withColumn("at", F.explode(F.filter(places, lambda p: p["far"] >= F.col("need"))))
    left = left.select("query_id", "dim", "vector", "length", "bound", "part", "at.bucket", F.explode(F.sequence("at.begin", F.col("at.end") - 1)).alias("sub"))
    keys = ("dim", "bucket", "sub", "part")
    right = spread.select("vec_id", "vector", "length", *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, f"query_id long, vec_id long, score {kind}")


def matrix(table: pa.Table, column: str = "vector") -> np.ndarray:
    """The vectors of one dimension as rows."""
    if not table.num_rows:
        return np.zeros((0, 0))
    return table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def first_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, best first. All ties at the border are looked at."""
    if len(scores) > k:
        border = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= border)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def ranked(partial: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score from partial lists that hold each query's k best.

    A query's list has at most k rows from each cell that it met in a round.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
