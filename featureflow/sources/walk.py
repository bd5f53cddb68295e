"""Listing file trees and reading Parquet footers in tasks: one directory level a step, one row for each entry.

Spark's own listing hides empty files and names that begin with a dot or an underscore, and shows no folders; these
functions show everything. Tasks open local (or mounted) trees themselves, and what pyarrow can open from where it runs
(S3, GCS, HDFS if set up). Any other tree is listed by the driver's Hadoop client, folder by folder.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.sources.files import hadoop_path, qualified, require_path
from featureflow.sources.settle import spread
from featureflow.sources.store import scratch

ENTRIES = "path string, directory boolean, link boolean, length long, mtime long"
FOOTERS = "path string, rows long, columns array<string>, error string"

#: Entries listed, and footers read, before they are handed on; footers read at a time in a task.
CHUNK = 5000
THREADS = 8


def local_path(uri: str) -> str | None:
    """The file system path of a ``file:`` URI in Spark's spelling."""
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else None


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system and path; raises if it knows none."""
    scheme, _, rest = uri.partition("://")
    scheme = "s3" if scheme == "s3a" else scheme
    system, _ = pafs.FileSystem.from_uri(f"{scheme}://{rest.split('/')[0]}")
    return system, rest


def opens_in_tasks(uri: str) -> bool:
    """Whether tasks can open the tree; tried on the driver, which is assumed to be set up as the tasks are."""
    if local_path(uri) is not None:
        return True
    try:
        system, path = _opened(uri)
        return system.get_file_info(path).type != pafs.FileType.NotFound
    except (OSError, ValueError, pa.ArrowException):
        return False


def _entries(uri: str) -> Iterator[tuple]:
    """(path, directory, link, length, mtime) of what is directly in a folder; nothing if it has gone."""
    folder = local_path(uri)
    if folder is None:
        system, path = _opened(uri)
        for info in system.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
            is_dir = info.type == pafs.FileType.Directory
            yield f"{uri}/{info.base_name}", is_dir, False, 0 if is_dir else info.size, int(info.mtime_ns // 1000) if info.mtime_ns else None
        return
    try:
        with os.scandir(folder) as found:
            for entry in found:
                try:
                    stat, is_dir = entry.stat(), entry.is_dir()
                except OSError:  # a link to nothing
                    stat, is_dir = entry.stat(follow_symlinks=False), False
                yield f"{uri}/{entry.name}", is_dir, entry.is_symlink(), 0 if is_dir else stat.st_size, stat.st_mtime_ns // 1000
    except (FileNotFoundError, NotADirectoryError):
        return


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), types, strict=True)], names)

    for row in rows:
        held.append(row)
        if len(held) == CHUNK:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _below(folders: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = (path for b in batches for path in b.column("path").to_pylist())
        yield from _batches((entry for path in paths for entry in _entries(path)), ENTRIES)

    return spread(folders.select("path"), "path").mapInArrow(run, ENTRIES)


def _by_driver(spark: SparkSession, root: str) -> DataFrame:
    fs, top = hadoop_path(spark, root)
    found, folders = [], [fs.makeQualified(top)]
    while folders:
        for status in fs.listStatus(folders.pop()):
            path, is_dir = status.getPath(), status.isDirectory()
            found.append((path.toString(), is_dir, False, 0 if is_dir else status.getLen(), status.getModificationTime() * 1000))
            if is_dir:
                folders.append(path)
    return spark.createDataFrame(found, ENTRIES)


def walk(spark: SparkSession, root: str) -> DataFrame:
    """All that lies below ``root``: path, directory, link, length (0 for folders), mtime (microseconds).

    Tasks list the folders of a level; the next level's folders are among what they found. Each level is written to the
    scratch folder, so a lost executor costs one level. Links to folders are shown, not followed. A missing root raises.
    """
    require_path(spark, root)
    top = qualified(spark, root)
    if not opens_in_tasks(top):
        return _by_driver(spark, root)
    base, level = scratch(spark), 0
    folders = spark.createDataFrame([(top,)], "path string")
    while True:
        _below(folders).write.parquet(f"{base}/level={level}")
        found = spark.read.schema(ENTRIES).parquet(f"{base}/level={level}")
        folders = found.where("directory and not link")
        if folders.isEmpty():
            return spark.read.schema(ENTRIES).parquet(*[f"{base}/level={i}" for i in range(level + 1)])
        level += 1


def _footer(uri: str, content: bytes | None = None) -> tuple:
    """(path, rows, top-level columns, error) from the end of a Parquet file."""
    try:
        folder = local_path(uri)
        if content is not None:
            found = pq.read_metadata(pa.BufferReader(content))
        elif folder is None:
            system, path = _opened(uri)
            with system.open_input_file(path) as source:
                found = pq.ParquetFile(source).metadata
        else:
            found = pq.read_metadata(folder)
        leaves = [found.schema.column(i).path for i in range(found.num_columns)]
        try:
            names = found.schema.to_arrow_schema().names
        except (pa.ArrowException, NotImplementedError):  # a type that Arrow lacks
            names = list(dict.fromkeys(leaf.split(".")[0] for leaf in leaves))
        return uri, found.num_rows, names, None
    except (OSError, pa.ArrowException) as error:
        return uri, None, None, f"{type(error).__name__}: {error}"[:300]


def footers(files: DataFrame) -> DataFrame:
    """path, rows, columns, error for each Parquet file (path): its footer, read by a task; an error is that file's alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            with ThreadPoolExecutor(THREADS) as pool:
                for b in batches:
                    for part in (b.slice(i, CHUNK) for i in range(0, b.num_rows, CHUNK)):
                        yield from pool.map(_footer, part.column("path").to_pylist())

        yield from _batches(rows(), FOOTERS)

    return spread(files.select("path"), "path").mapInArrow(run, FOOTERS)


def footers_of_contents(files: DataFrame) -> DataFrame:
    """The same from (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((_footer(*row) for b in batches for row in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True)), FOOTERS)

    return files.mapInArrow(run, FOOTERS)
