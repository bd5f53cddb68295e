"""Helpers the operators of this subpackage share: inputs, stored stages, folds, byte-bounded Arrow slices."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled at once inside a task; a single longer text is handled alone.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The folder that `shared_folder` uses within `scratch_folder`.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """All that is stored within the block goes below one folder, which is deleted at its end."""
    path = shared_folder(spark)
    before = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(before)
        discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share (`spark.checkpoint.dir`).

    Only a local master without that setting gets a folder of its own, as in tests.
    """
    if _SCRATCH.get():
        return f"{_SCRATCH.get()}/{uuid.uuid4().hex}"
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root}/llm-{uuid.uuid4().hex}"


#: Spark's own setting: a finished query's shuffle files go at once, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: lineage ends here, lost executors do not matter.

    What was shuffled for it is deleted when it is written.
    """
    spark = frame.sparkSession
    path = path or shared_folder(spark)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % parts


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just (doc_id, text); other columns, whatever their names, stay outside. A null text becomes empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, last: bool = True) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that the texts of a slice, or its lists of 32-bit numbers, stay below `limit` bytes, or are one.

    `last`: the task ends with the batches.
    """
    for batch in batches:
        values = batch.column(column)
        lengths = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
        sizes = lengths.fill_null(0).to_pylist()
        begin = held = 0
        for row, size in enumerate(sizes):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
        del batch
    if last:
        give_back()


def give_back() -> None:
    """At a task's end: what it freed goes back to the machine, since the worker stays for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library is another
        ctypes.CDLL(None).malloc_trim(0)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A broadcast of `value`, as a function that tasks call once. Classes travel with it: workers need no copy of the package."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def judged(docs: DataFrame, text_col: str, judge: Callable[[], Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """The rows of `docs` that a judge says yes to, given their texts (null: empty); all columns stay as they are.

    `judge` makes one judge for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = judge()
        for part in slices(batches, text_col):
            yield part.filter(pa.array(keep(part.column(text_col).fill_null(""))))

    return docs.mapInArrow(run, docs.schema)
