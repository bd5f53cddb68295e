"""Second moments of vectors as a distributed job.

Every task multiplies its Arrow batches with BLAS into one d x d block and emits it once, row by row. The blocks are
summed in levels: the rows of FAN neighbouring tasks first, then of FAN such groups, and so on, so that no key of a
sum gets more than some FAN rows, whatever the number of tasks. The work per row stays vectorised and what is shuffled
is (tasks) x d x d / 2 numbers. The tasks are the scan's own; ``tasks`` merges small splits where there are many. A
task holds one block, (d + 1)^2 doubles, and the driver another where a result is decomposed there.

Where d x d numbers are too many, ``covariance_product`` multiplies the covariance with a few columns instead: d x
columns numbers in a task, and the same levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.vectors import as_array

#: Rows of the product made at once, so that the block is the only d x d array of a task.
STRIP = 256
#: Partial sums that one key of a level gets.
FAN = 64
#: Levels below the last sum where the number of tasks cannot be told before the job, and at most.
UNKNOWN_LEVELS, MOST_LEVELS = 1, 3


def matrix(values: pa.Array, d: int) -> np.ndarray:
    """Arrow list column without nulls as an n x d double matrix."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(values.offsets.to_numpy())
    if len(lengths) and not (lengths == d).all():
        raise ValueError(f"vectors must all have length {d}")
    return flat.astype(np.float64, copy=False).reshape(-1, d)


def pivot_vector(df: DataFrame, column: str) -> np.ndarray:
    """One row's vector, used as the origin: moments around it do not cancel when means are large."""
    vectors = df.select(as_array(df, column).alias("v"))
    head = vectors.head()
    if head is not None and head["v"] is None:
        head = vectors.filter(F.col("v").isNotNull()).head()
    if head is None:
        raise ValueError(f"no vectors in column '{column}'")
    pivot = np.asarray(head["v"], dtype=np.float64)
    return np.where(np.isfinite(pivot), pivot, 0.0)


def levels(df: DataFrame, tasks: int | None = None) -> int:
    """Levels of sums below the last one: as many as leave at most FAN rows for each of its keys.

    The number of tasks is estimated from the bytes the plan reads, without running anything.
    """
    if tasks is None:
        spark = df.sparkSession
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        if size >= 1 << 62:
            return UNKNOWN_LEVELS
        split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        tasks = max(-(-size // split), spark.sparkContext.defaultParallelism)
    found = 0
    while tasks > FAN and found < MOST_LEVELS:
        tasks, found = -(-tasks // FAN), found + 1
    return found


def summed(blocks: DataFrame, below: int) -> DataFrame:
    """``i, s array``: the sums of the rows ``task, i, s`` with the same i, after ``below`` levels of partial sums."""
    add = Summarizer.sum(F.col("v")).alias("v")
    rows = blocks.select("task", "i", array_to_vector("s").alias("v"))
    for _ in range(below):
        rows = rows.groupBy(F.floor(F.col("task") / FAN).alias("task"), "i").agg(add)
    return rows.groupBy("i").agg(add).select("i", vector_to_array("v").alias("s"))


def _strips(block: np.ndarray, upper: bool) -> Iterator[pa.RecordBatch]:
    """The rows of a block as ``task, i, s``, from the diagonal on if ``upper``; a few at a time."""
    task = TaskContext.get().partitionId()
    for start in range(0, len(block), STRIP):
        rows = range(start, min(start + STRIP, len(block)))
        values = [block[i, i:] if upper else block[i] for i in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(rows), pa.int64()), pa.array(list(rows), pa.int32()), pa.array(values, pa.list_(pa.float64()))],
            names=["task", "i", "s"],
        )


_BLOCK = "task long, i int, s array<double>"


def moments(df: DataFrame, column: str, pivot: np.ndarray, tasks: int | None = None) -> DataFrame:
    """``i, s array``: row i of the upper triangle of sum((1, x-p) (1, x-p)^T); row 0 holds n and the sums.

    ``tasks``: merge the scan's splits into so many; none by default.
    """
    d = len(pivot)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = np.zeros((d + 1, d + 1))
        for batch in batches:
            x = matrix(batch.column(0).drop_null(), d) - pivot
            block[0, 0] += len(x)
            block[0, 1:] += x.sum(axis=0)
            for start in range(0, d, STRIP):  # the upper triangle, strip by strip
                block[1 + start : 1 + start + STRIP, 1 + start :] += x[:, start : start + STRIP].T @ x[:, start:]
        if block[0, 0] > 0:
            yield from _strips(block, upper=True)

    vectors = df.select(as_array(df, column, stored_precision(df, column)).alias("v"))
    # Nulls are dropped in the task: a filter here would be pushed below whatever computes the vectors, and
    # compute them twice.
    vectors = vectors if tasks is None else vectors.coalesce(tasks)
    return summed(vectors.mapInArrow(partial, _BLOCK), levels(vectors, tasks))


def column_moments(df: DataFrame, column: str, pivot: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, sum of squares around the mean) of every column; 2 d numbers for each task."""
    d = len(pivot)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = np.zeros((3, d))
        for batch in batches:
            x = matrix(batch.column(0).drop_null(), d) - pivot
            block += np.stack([np.full(d, len(x)), x.sum(axis=0), (x * x).sum(axis=0)])
        if block[0, 0] > 0:
            yield from _strips(block, upper=False)

    vectors = df.select(as_array(df, column, stored_precision(df, column)).alias("v"))
    found = {row["i"]: np.array(row["s"]) for row in summed(vectors.mapInArrow(partial, _BLOCK), levels(vectors)).collect()}
    n = round(found[0][0]) if found and np.isfinite(found[0][0]) else 0
    if n < 2:
        raise ValueError("a covariance needs at least two vectors")
    if not all(np.isfinite(x).all() for x in found.values()):
        raise ValueError(f"column '{column}' holds NaN or infinite elements")
    return n, pivot + found[1] / n, found[2] - found[1] ** 2 / n


def covariance_product(df: DataFrame, column: str, n: int, mean: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sample covariance times the d x m matrix ``right``, in one pass over the rows.

    ``right`` is broadcast; a task holds d x m numbers besides a batch, the driver gets d x m. No one holds d x d.
    """
    d, shared = len(mean), df.sparkSession.sparkContext.broadcast(right)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, some = np.zeros((d, shared.value.shape[1])), False
        for batch in batches:
            x = matrix(batch.column(0).drop_null(), d) - mean
            block += x.T @ (x @ shared.value)
            some = some or len(x) > 0
        if some:
            yield from _strips(block, upper=False)

    vectors = df.select(as_array(df, column, stored_precision(df, column)).alias("v"))
    out = np.zeros((d, right.shape[1]))
    for row in summed(vectors.mapInArrow(partial, _BLOCK), levels(vectors)).toLocalIterator():
        out[row["i"]] = row["s"]
    shared.unpersist()
    return out / (n - 1)


def stored_precision(df: DataFrame, column: str) -> str:
    """``float32`` for a stored array<float>: it goes to Python as it is and is widened there."""
    return "float32" if df.schema[column].dataType.simpleString() == "array<float>" else "float64"


def covariance(
    df: DataFrame, column: str = "features", pivot: np.ndarray | None = None
) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, sample covariance) on the driver; d*d numbers, whatever the number of rows."""
    pivot = pivot_vector(df, column) if pivot is None else pivot
    d = len(pivot)
    block = np.zeros((d + 1, d + 1))
    for row in moments(df, column, pivot).collect():
        block[row["i"], row["i"]:] = row["s"]
    n = round(block[0, 0]) if np.isfinite(block[0, 0]) else 0  # the summed count has the rounding of a mean
    if n < 2:
        raise ValueError("a covariance needs at least two vectors")
    if not np.isfinite(block).all():
        raise ValueError(f"column '{column}' holds NaN or infinite elements")
    mean = block[0, 1:] / n
    upper = (block[1:, 1:] - n * np.outer(mean, mean)) / (n - 1)
    full = np.triu(upper) + np.triu(upper, 1).T
    return n, mean + pivot, full


def covariance_long(df: DataFrame, column: str = "features") -> DataFrame:
    """Sample covariance as ``i, j, covariance`` (zero-based, both triangles); the matrix stays distributed."""
    sums = moments(df, column, pivot_vector(df, column))
    first = sums.filter(F.col("i") == 0).select("s").scalar()
    n = F.round(first[0])
    cells = sums.filter(F.col("i") > 0).select(F.col("i"), F.posexplode("s").alias("o", "q"))
    a, b = F.col("i"), F.col("i") + F.col("o")
    value = F.try_divide(F.col("q") - first[a] * first[b] / n, n - 1)
    upper = cells.select((a - 1).alias("i"), (b - 1).alias("j"), value.alias("covariance"))
    both = F.array(F.struct("i", "j", "covariance"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "covariance"))
    return upper.select(
        F.inline(F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both))
    )


def total_variance(df: DataFrame, column: str = "features") -> DataFrame:
    """One row: trace of the covariance matrix."""
    vectors = df.select(array_to_vector(as_array(df, column)).alias("v")).filter(F.col("v").isNotNull())
    one = vectors.agg(Summarizer.variance(F.col("v")).alias("s"))
    return one.select(
        F.aggregate(vector_to_array("s"), F.lit(0.0), lambda a, x: a + x).alias("total_variance")
    )
