"""Sinks, fingerprinted materialisation and the run log."""

from __future__ import annotations

import contextlib
import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.vectors import as_array, expand
from featureflow.sources.files import exists, hadoop_path, list_files

MARKER = "_fingerprint"
RUN_LOG = "ts timestamp, step string, details string, rows long"


def write_parquet(
    df: DataFrame, path: str, overwrite: bool = True, partition_by: Sequence[str] = (), marker: str | None = None
) -> None:
    """Parquet write; an existing target raises unless ``overwrite``.

    The rows go to a new folder beside the target, which takes its place when they are complete, ``marker`` included: a
    job that fails leaves the old result as it was, and ``df`` may read what it replaces.
    """

    def write(target: str) -> None:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(target)
        if marker is not None:
            write_text(df.sparkSession, f"{target}/{MARKER}", marker)

    replace(df.sparkSession, path, write, overwrite)


def replace(spark: SparkSession, path: str, write: Callable[[str], None], overwrite: bool = True) -> None:
    """``write`` makes a dataset in the folder it is given, which then becomes ``path`` by renaming.

    The old one is put aside before and deleted after; should the driver die between the two renames, the next
    ``replace`` or ``restore`` puts it back.
    """
    restore(spark, path)
    fs, target = hadoop_path(spark, path.rstrip("/"))
    there = fs.exists(target)
    if there and not overwrite:
        write(path)  # Spark's own error
        return
    new, old = (f"{target.getParent()}/_{target.getName()}.{kind}" for kind in (f"{uuid.uuid4().hex}.new", "old"))
    try:
        write(new)
        if there:
            _rename(spark, path, old)
        _rename(spark, new, path)
    except BaseException:
        fs.delete(hadoop_path(spark, new)[1], True)
        restore(spark, path)
        raise
    if there:
        fs.delete(hadoop_path(spark, old)[1], True)


def restore(spark: SparkSession, path: str) -> bool:
    """Puts back a dataset that was put aside and never replaced. Whether it did."""
    fs, target = hadoop_path(spark, path.rstrip("/"))
    old = f"{target.getParent()}/_{target.getName()}.old"
    if not exists(spark, old):
        return False
    if fs.exists(target):  # replaced, but not cleaned up
        fs.delete(hadoop_path(spark, old)[1], True)
        return False
    _rename(spark, old, path)
    return True


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, place = hadoop_path(spark, source)
    if not fs.rename(place, hadoop_path(spark, target.rstrip("/"))[1]):
        raise OSError(f"cannot rename {source} to {target}")


def csv_ready(df: DataFrame, vectors: str = "json") -> DataFrame:
    """CSV holds scalars only: vectors and nested columns become JSON text (``json``) or go (``drop``)."""
    out = []
    for field in df.schema.fields:
        vector = isinstance(field.dataType, VectorUDT)
        if not vector and not isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType, T.BinaryType)):
            out.append(F.col(field.name))
        elif vectors == "json":
            if isinstance(field.dataType, T.BinaryType):
                out.append(F.base64(field.name).alias(field.name))
            else:
                value = as_array(df, field.name) if vector else F.col(field.name)
                out.append(F.to_json(value).alias(field.name))
        elif vectors != "drop":
            raise ValueError("vectors must be 'json' or 'drop'")
    return df.select(*out)


def write_csv(df: DataFrame, path: str, vectors: str = "drop", single_file: bool = False) -> None:
    """CSV with header. ``single_file`` funnels everything through one task; keep it for small results."""
    ready = csv_ready(df, vectors)
    if single_file:
        ready = ready.coalesce(1)
    replace(df.sparkSession, path, lambda target: ready.write.option("header", True).csv(target))


def write_expanded_csv(
    df: DataFrame, path: str, column: str = "pca_features", prefix: str = "pca_", length: int | None = None
) -> None:
    """One CSV column per vector element, written by the executors."""
    wide = expand(df, column, prefix, length)
    replace(df.sparkSession, path, lambda target: wide.write.option("header", True).csv(target))


def parquet_to_csv(spark: SparkSession, source: str, path: str, vectors: str = "json") -> None:
    """The whole dataset, every part file."""
    write_csv(spark.read.parquet(source), path, vectors)


def source_fingerprint(spark: SparkSession, roots: Sequence[str]) -> str:
    """Order-free digest of (path, length, mtime) of all files below the roots, aggregated by the executors."""
    parts = []
    for root in roots:
        row = (
            list_files(spark, root)
            .select(F.xxhash64("path", "length", F.unix_micros("modificationTime")).alias("h"), "length")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum("length"), F.lit(0)).alias("b"),
                F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"),
                F.coalesce(F.sum(F.pmod("h", F.lit(1_000_000_007))), F.lit(0)).alias("s"),
            )
            .head()
        )
        parts.append([root, *row])
    return json.dumps(parts)


def fingerprint(params: dict[str, Any], sources: str = "", schema: T.StructType | None = None) -> str:
    text = json.dumps([params, sources, schema.json() if schema is not None else ""], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file; without ``overwrite`` an existing one is an error."""
    fs, file = hadoop_path(spark, path)
    out = fs.create(file, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if it is not there."""
    fs, file = hadoop_path(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def materialize(
    spark: SparkSession,
    path: str,
    compute: Callable[[], DataFrame],
    params: dict[str, Any] | None = None,
    sources: Sequence[str] = (),
    refresh: bool = False,
) -> DataFrame:
    """Compute-or-reload of a stage.

    The stage is reused only if it was completed with the same parameters over the same source files;
    otherwise it is recomputed and overwritten. The written data is read back, so nothing downstream can
    repeat the computation. The marker comes with the rows: a half-written stage is never reused, and a computation
    that fails leaves the stage it would have replaced. For stages with a row or more for each source file,
    ``stages.follow`` computes only what changed.
    """
    wanted = fingerprint(params or {}, source_fingerprint(spark, sources) if sources else "")
    restore(spark, path)
    if refresh or read_text(spark, f"{path}/{MARKER}") != wanted:
        write_parquet(compute(), path, marker=wanted)
    return spark.read.parquet(path)


def invalidate(spark: SparkSession, path: str) -> bool:
    """Forget a materialised stage without prompting: its marker goes, so the next run overwrites it."""
    fs, marker = hadoop_path(spark, f"{path}/{MARKER}")
    return fs.exists(marker) and fs.delete(marker, False)


def scratch(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``).

    A local master without that setting gets a temporary folder of its own.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="featureflow-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root}/scratch-{uuid.uuid4().hex}"


def rewritten(df: DataFrame, path: str) -> DataFrame:
    """The frame, written to ``path`` and read back."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def keep_in_memory(df: DataFrame) -> DataFrame:
    """Cache with spill to disk; release with ``unpersist``. Lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def log_step(spark: SparkSession, log_path: str, step: str, details: str = "", rows: int | None = None) -> None:
    """Append one row to the run log."""
    entry = spark.createDataFrame([(step, details, rows)], "step string, details string, rows long")
    entry.select(F.current_timestamp().alias("ts"), "step", "details", "rows").coalesce(1).write.mode("append").parquet(log_path)


def write_logged(
    df: DataFrame, path: str, log_path: str, step: str, details: str = "", overwrite: bool = True
) -> int:
    """Write a stage and log its row count, observed during the write instead of by a second job."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, overwrite)
    rows = seen.get["rows"]
    log_step(df.sparkSession, log_path, step, details, rows)
    return rows
