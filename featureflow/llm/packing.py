"""Packing by concatenate and cut: documents' ids in a row, cut into windows of a fixed number of tokens.

Pass 1 encodes each input partition and numbers its ids from 0; the prefix sum of the partitions' totals gives every
partition its place in the whole row. Pass 2 cuts each document at the window borders. Nothing is shuffled but one
total for each partition, and only the last sequence has padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import slices, stored, texts_of
from featureflow.llm.token_files import bases, encoded

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut(first: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents at global positions `first`: (document, start in it, length) of each piece between window borders."""
    count = np.where(lengths > 0, (first + lengths - 1) // window - first // window + 1, 0)
    doc = np.repeat(np.arange(len(first)), count)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    begin = np.maximum((first[doc] // window + nth) * window, first[doc])
    end = np.minimum((first[doc] // window + nth + 1) * window, first[doc] + lengths[doc])
    return doc, begin - first[doc], end - begin


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    Sequence s holds the pieces of that sequence_id by offset, which starts at 0 and has no gaps. A null or empty text
    is its end id alone. Rows with null or repeated ids are packed like others; other columns are ignored; an empty
    table gives no pieces.
    """
    rows = stored(encoded(texts_of(docs, id_col, text_col), tokenizer_path, end_id))
    placed = rows.join(F.broadcast(bases(rows)), "part").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            ids = batch.column("ids")
            flat, offsets = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy().astype(np.int64)
            first, lengths = batch.column("first").to_numpy(), np.diff(offsets)
            doc, start, length = cut(first, lengths, window)
            at = offsets[doc] + start
            sums = [zlib.crc32(flat[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            place = first[doc] + start
            out = [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(lengths[doc]), pa.array(place // window), pa.array(place % window)]
            names = [field.split()[0] for field in _PIECE.split(", ")]
            if with_ids:  # a document's pieces follow each other, so their ids do
                borders = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(borders), pa.array(flat[offsets[0] : offsets[-1]].view(np.int32))))
                names.append("ids")
            yield pa.record_batch(out, names)

    return placed.mapInArrow(run, _PIECE + (", ids array<int>" if with_ids else ""))


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (padded to `window`) and the boundaries, one record (doc_id, start, offset, length) for each piece."""
    boundary = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(boundary)).alias("b"))
    flat = F.flatten(F.transform("b", lambda x: x["ids"]))
    return rows.select(
        "sequence_id",
        F.concat(flat, F.array_repeat(F.lit(pad_id), F.lit(window) - F.size(flat))).alias("ids"),
        F.transform("b", lambda x: F.struct(x["doc_id"], x["start"], x["offset"], x["length"])).alias("boundaries"),
    )
