"""Token ids as ORC files: documents in id order, integer run-length encoding, row indexes and Bloom filters on the ids.

A file holds a contiguous range of document ids, sorted; a row holds a document's ids and the number of ids before it
in the file. Readers split files by stripe, skip stripes and row groups by the statistics and Bloom filters of
`doc_id`, and get global positions from one sum for each file, which is written beside the files once (`_bases`).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.llm import tokens
from featureflow.llm.common import slices, texts_of

#: Where the sums stand; other readers of the folder pass over it.
BASES = "_bases"
SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"


def encoded(rows: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, text) to SCHEMA in the order of the rows; `before` counts the ids earlier in the same partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, before = tokens.encoder(tokenizer_path), 0
        for rows in slices(batches, "text", tokens.TEXT_BYTES):
            ids, offsets = encoder.encode(rows.column("text"), end_id)
            n = rows.num_rows
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.record_batch(
                [rows.column("doc_id"), pa.array(np.full(n, part, np.int32)), pa.array(before + offsets[:-1]), pa.array(np.diff(offsets)), lists],
                ["doc_id", "part", "before", "n_tokens", "ids"],
            )
            before += int(offsets[-1])

    return rows.select("doc_id", "text").mapInArrow(run, SCHEMA)


def bases(rows: DataFrame) -> DataFrame:
    """part, base: ids in all parts before it. The second pass of the prefix sum, over one row for each part.

    Parts follow one another as their numbers do, which is the order of ids where the rows were laid out by id. The
    result may be broadcast: 12 bytes for each task that wrote rows.
    """
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", stripe_mb: int = 64) -> None:
    """Writes the ids of every whole text, then `end_id`, to ORC files at `path`, in ascending order of ids.

    A null or empty text is its end id alone. Null ids come first; rows that share an id follow each other in the
    order of their texts. Other columns are not written; an empty table makes files without rows.
    """
    rows = texts_of(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        encoded(rows, tokenizer_path, end_id)
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", stripe_mb << 20)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", 1000)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )
    bases(docs.sparkSession.read.schema(SCHEMA).orc(path)).coalesce(1).write.parquet(f"{path}/{BASES}")


def read_tokens(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids. `where` on doc_id reaches the files' indexes.

    Of files and stripes that their indexes rule out nothing is read: the positions come from the small table of sums.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    found = rows.where(where) if where else rows
    sums = spark.read.schema("part int, base long").parquet(f"{path}/{BASES}")
    return found.join(F.broadcast(sums), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """The rows with ids_crc32 (unsigned, over little-endian unsigned 32-bit ids) in place of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, offsets = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            kept = [name for name in batch.schema.names if name != "ids"]
            yield pa.record_batch([*(batch.column(n) for n in kept), pa.array(sums, pa.int64())], [*kept, "ids_crc32"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ids"]
    return rows.mapInArrow(run, ", ".join([*kept, "ids_crc32 long"]))
