"""Removal of byte strings that an earlier document already has: sampled grams, matched and refined in hash rounds.

A byte goes if a string of `span` bytes that covers it also starts in a document with a smaller id. Plain prefix
doubling would sort every position by (rank of its first h bytes, rank of the h bytes after them) for growing h: a row
for each byte of the corpus in each round, which the disk at hand does not hold. So this is not prefix doubling: fixed
rounds name strings by hashes of their bytes, and only the last joins two halves.

The first round sorts sampled positions by their first `GRAM` bytes: in each string of `span` bytes the position
whose gram has the least hash stands for it, so equal strings are represented at the same place. Positions whose gram
no other document shares drop out, which are most. Positions are then compared by all that they represent; where that
is the same as in a smaller document, all its strings are. Positions that differ around a shared gram are compared by
the gram and half of the rest on its right, and on its left: a string of `span` bytes holds one of the two. What is
still shared reaches the last round, which compares each string's start by the names of its halves.

Names have 64 bits, and strings count as equal if names of 96 bits or more agree. Before each sort a task combines what
it has: of equal keys only the smallest document is sent, so a passage in a third of all documents is one row from each
task.

Rows that share an id are told apart by 16 bits of a checksum of their texts: of two different texts under one id, one
pair in 65,536 gets each other's cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import slices, stored
from featureflow.llm.near_dedup import mixed

SPAN = 50
GRAM = 16
#: Lengths that the packed rows have room for.
LEAST_SPAN, MOST_SPAN = 32, 79
#: Bytes whose positions are combined before a sort; bytes hashed at once (a longer text alone).
CHUNK_BYTES = 4 << 20
HASH_BYTES = 1 << 17

_POWER = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))
_NAMES = mixed(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, 256)
#: Low bits of a gram's hash that give way to its place, so that ties go to the leftmost; a block has fewer bytes.
_PLACE = (1 << 31) - 1
#: The rank of a second half has 32 bits, beside 64 of the first: the largest sort gets by with less.
_SHORT = np.uint64((1 << 32) - 1)


class Hashes:
    """Names of any substring of a byte block, from prefix sums of powers modulo 2^64."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, block: np.ndarray, table: int) -> None:
        n = len(block)
        if len(Hashes._powers) <= n:
            Hashes._powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _POWER))))
            Hashes._inverses = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _INVERSE))))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_NAMES[table][block] * Hashes._powers[:n], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        """Names of all substrings of that length."""
        n = max(len(self.sums) - length, 0)
        return mixed((self.sums[length:] - self.sums[:n]) * Hashes._inverses[:n])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * Hashes._inverses[begin])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values."""
    least, have = values, 1
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    return np.minimum(least[: len(least) - (width - have)], least[width - have :]) if have < width else least


def blocks(batch: pa.RecordBatch, limit: int = HASH_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets of the texts in them, first row) for consecutive rows of a batch with a binary column `raw`."""
    for part in slices(iter([batch]), "raw", limit, last=False):
        raw = part.column("raw")
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
        data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if raw.buffers()[2] else np.zeros(0, np.uint8)
        yield data, offsets - offsets[0], part.column("row").to_numpy()[0]


def sampled(data: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, gram's name, name of all it represents, first start, number of starts, gram's distance from the first).

    The starts of all strings of `span` bytes are dealt out to the positions, in order, each to one.
    """
    starts = np.maximum(np.diff(offsets) - span + 1, 0)
    total = int(starts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none
    grams = Hashes(data, 0).every(gram)
    order = (grams & ~np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_least(order, span - gram + 1)
    text = np.repeat(np.arange(len(starts)), starts)
    start = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(starts) - starts), starts)
    picked = (least[start] & np.uint64(_PLACE)).astype(np.int64)
    fresh = np.ones(total, bool)
    fresh[1:] = (picked[1:] != picked[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, total))
    begin, at = start[first], picked[first]
    around = Hashes(data, 1).of(begin, begin + count - 1 + span)
    around = mixed(around + mixed(grams[at]) * np.uint64(63) + (at - begin).astype(np.uint64))
    return text[first], grams[at], around, begin - offsets[text[first]], count, at - begin


def _group_least(keys: tuple[np.ndarray, ...], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group number of each row, least document of each group) for equal keys."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    if len(order):
        fresh[0] = True
    for key in keys:
        fresh[1:] |= key[order][1:] != key[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    least = np.minimum.reduceat(docs[order], np.flatnonzero(fresh)) if len(order) else docs
    return group, least


def _ranges(doc: np.ndarray, tag: np.ndarray, begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts to remove as ranges, those that follow each other in a document joined."""
    order = np.lexsort((begin, tag, doc))
    doc, tag, begin, end = doc[order], tag[order], begin[order], (begin + count)[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (begin[1:] != end[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1 if len(first) else first
    return doc[first], tag[first], begin[first], end[last] - begin[first]


_ROW = "gram long, around long, doc_id long, place long"
_NAMES_OF_ROW = [f.split()[0] for f in _ROW.split(", ")]
#: kinds: LEAST looks for smaller documents with its gram; INNER has one in its own task; DONE is a range to remove.
LEAST, INNER, DONE = 0, 1, 2
_SHARED, _MIXED = 4, 8
#: `place` holds the kind, the row's tag, the first start, how far from it the gram is, and the number of starts less
#: one. It is sorted for every sampled position, so it is kept short. A DONE row, whose number has no limit, has it in
#: `around`.
_KIND_AT, _TAG_AT, _BEGIN_AT, _GRAM_AT = 60, 44, 12, 6


def _rows(kind, gram, around, doc, tag, begin, n, at=0) -> pa.RecordBatch:
    kind = np.broadcast_to(np.asarray(kind), doc.shape).astype(np.uint64)
    place = kind << np.uint64(_KIND_AT) | tag.astype(np.uint64) << np.uint64(_TAG_AT) | begin.astype(np.uint64) << np.uint64(_BEGIN_AT)
    place = place | np.where(kind == DONE, 0, n - 1 + (np.asarray(at) << _GRAM_AT)).astype(np.uint64)
    around = np.where(kind == DONE, n.astype(np.uint64), around)
    return pa.record_batch([pa.array(c) for c in (gram.view(np.int64), around.view(np.int64), doc, place.view(np.int64))], _NAMES_OF_ROW)


def _bits(name: str, first: int, end: int) -> Column:
    return F.shiftrightunsigned(name, first).bitwiseAND((1 << (end - first)) - 1)


def _taken_apart(rows: DataFrame) -> DataFrame:
    n = F.when(_bits("place", _KIND_AT, 62) == DONE, F.col("around")).otherwise(_bits("place", 0, _GRAM_AT) + 1)
    parts = {"tag": _bits("place", _TAG_AT, _KIND_AT).cast("int"), "begin": _bits("place", _BEGIN_AT, _TAG_AT), "at": _bits("place", _GRAM_AT, _BEGIN_AT), "n": n}
    return rows.withColumns(parts).drop("place")


def _first_round(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in slices(batches, "raw", CHUNK_BYTES):
            ids, tags = chunk.column("doc_id").to_numpy(), chunk.column("tag").to_numpy()
            chunk = chunk.append_column("row", pa.array(np.arange(chunk.num_rows)))
            found = []
            for data, offsets, row in blocks(chunk):
                text, *rest = sampled(data, offsets, span, gram)
                found.append((text + row, *rest))
            text, grams, around, begin, count, at = (np.concatenate(x) for x in zip(*found, strict=True))
            doc, tag = ids[text], tags[text]
            of_gram, gram_least = _group_least((grams,), doc)
            of_all, all_least = _group_least((around,), doc)
            done = all_least[of_all] < doc
            yield _rows(DONE, *_done(*_ranges(doc[done], tag[done], begin[done], count[done])))
            inner = (gram_least[of_gram] < doc) & ~done
            n_groups = len(gram_least)
            shared, several = np.zeros(n_groups, bool), np.zeros(n_groups, bool)
            shared[of_gram[doc > gram_least[of_gram]]] = True
            some = np.zeros(n_groups, np.uint64)
            some[of_gram] = around
            several[of_gram[around != some[of_gram]]] = True
            least = ~inner & ~done
            kind = LEAST + _SHARED * shared[of_gram[least]] + _MIXED * several[of_gram[least]]
            yield _rows(kind, grams[least], around[least], doc[least], tag[least], begin[least], count[least], at[least])
            yield _rows(INNER, _own_key(doc[inner], begin[inner]), around[inner], doc[inner], tag[inner], begin[inner], count[inner], at[inner])

    return run


def _own_key(doc: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A key for rows that no group has to meet, so that they spread evenly."""
    return mixed(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + begin.astype(np.uint64))


def _done(doc, tag, begin, n) -> tuple[np.ndarray, ...]:
    return _own_key(doc, begin), np.zeros(len(doc), np.uint64), doc, tag, begin, n


def _parts(own: pa.Array) -> tuple[np.ndarray, ...]:
    """(text, first start, gram's distance, number of starts) of each packed part of the texts."""
    packed = own.flatten().to_numpy()
    text = np.repeat(np.arange(len(own)), np.diff(own.offsets.to_numpy()))
    return text, packed >> 16, (packed >> 8) & 255, packed & 255


def _middle_round(span: int, gram: int):
    """Rows (doc_id, tag, raw, parts) to two rows for each part: gram and right half, left half and gram.

    A row has the starts whose strings hold those bytes, and their rank as its key.
    """
    half = (span - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in slices(batches, "raw", CHUNK_BYTES):
            ids, tags, parts = chunk.column("doc_id").to_numpy(), chunk.column("tag").to_numpy(), chunk.column("parts")
            chunk = chunk.append_column("row", pa.array(np.arange(chunk.num_rows)))
            found = []
            for data, offsets, row in blocks(chunk):
                text, begin, at, n = _parts(parts.slice(row, len(offsets) - 1))
                place, names = begin + at, Hashes(data, 1)
                for side in range(2):
                    first = np.maximum(begin, place - (span - gram - half)) if side == 0 else begin
                    last = begin + n - 1 if side == 0 else np.minimum(begin + n - 1, place - half)
                    use = np.flatnonzero(last >= first)
                    low = (offsets[text] + place - (half if side else 0))[use]
                    keys = mixed(names.of(low, low + gram + half) + np.uint64(side))
                    found.append((text[use] + row, keys, first[use], (last - first + 1)[use]))
            text, keys, begin, n = (np.concatenate(x) for x in zip(*found, strict=True))
            doc, tag = ids[text], tags[text]
            group, least = _group_least((keys,), doc)
            inner = least[group] < doc
            shared = np.zeros(len(least), bool)
            shared[group[inner]] = True
            none = np.zeros(len(doc), np.uint64)
            left = ~inner
            yield _rows(LEAST + _SHARED * shared[group[left]], keys[left], none[left], doc[left], tag[left], begin[left], n[left])
            yield _rows(INNER, _own_key(doc[inner], begin[inner]), none[inner], doc[inner], tag[inner], begin[inner], n[inner])

    return run


def _last_round(span: int):
    """Rows (doc_id, tag, raw, parts) to rows with the halves' ranks for each start."""
    half = span // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in slices(batches, "raw", CHUNK_BYTES // 4):
            ids, tags, parts = chunk.column("doc_id").to_numpy(), chunk.column("tag").to_numpy(), chunk.column("parts")
            chunk = chunk.append_column("row", pa.array(np.arange(chunk.num_rows)))
            found = []
            for data, offsets, row in blocks(chunk):
                text, begin, _, count = _parts(parts.slice(row, len(offsets) - 1))
                begin = np.repeat(begin + offsets[text], count)
                begin += np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count)
                text = np.repeat(text, count)
                names = [Hashes(data, i) for i in range(2)]
                found.append((text + row, names[0].of(begin, begin + half), names[1].of(begin + half, begin + span) & _SHORT, begin - offsets[text]))
            text, head, tail, begin = (np.concatenate(x) for x in zip(*found, strict=True))
            doc, tag = ids[text], tags[text]
            group, least = _group_least((head, tail), doc)
            one = np.ones(len(doc), np.int64)
            done = least[group] < doc
            yield _rows(DONE, *_done(*_ranges(doc[done], tag[done], begin[done], one[done])))
            left = ~done
            yield _rows(LEAST, head[left], tail[left], doc[left], tag[left], begin[left], one[left])

    return run


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tag, raw; the tag tells rows apart that share an id but not a text."""
    return docs.select(*_columns(id_col, text_col))


def _columns(id_col: str, text_col: str) -> list[Column]:
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return [F.col(id_col).cast("long").alias("doc_id"), (F.crc32(raw) % (1 << 16)).cast("int").alias("tag"), raw.alias("raw")]


def repeated_starts(rows: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, tag, begin, n: ranges of starts of strings that also start in a document with a smaller id."""
    if not LEAST_SPAN <= span <= MOST_SPAN:
        raise ValueError(f"span must be between {LEAST_SPAN} and {MOST_SPAN}")
    rows = rows.where("doc_id is not null").where(F.octet_length("raw") >= span)
    first = rows.mapInArrow(_first_round(span, gram), _ROW)
    same_gram = Window.partitionBy("gram")
    kind = _bits("place", _KIND_AT, 64)
    least, last = F.min("doc_id").over(same_gram), F.max("doc_id").over(same_gram)
    flags = F.bit_or(kind).over(same_gram)
    ranked = first.select(
        "around", "doc_id", "place", kind.bitwiseAND(3).alias("kind"), least.alias("least"),
        ((flags.bitwiseAND(_SHARED) > 0) | (least < last)).alias("shared"),
        ((flags.bitwiseAND(_MIXED) > 0) | (F.min("around").over(same_gram) < F.max("around").over(same_gram))).alias("mixed"),
    )
    alike = (F.col("kind") == LEAST) & ~F.col("mixed") & (F.col("doc_id") > F.col("least"))
    differing = (F.col("kind") == INNER) | ((F.col("kind") == LEAST) & F.col("shared") & F.col("mixed"))
    ranked = ranked.withColumn("kind", F.when(alike, LEAST).when(differing, INNER).when(F.col("kind") == DONE, DONE))
    found = stored(ranked.where("kind is not null").select("kind", "around", "doc_id", "place"))
    done = _taken_apart(found.where(F.col("kind") != INNER))
    inner = found.where(F.col("kind") == INNER).drop("kind")
    # a sum for each task and a join, whose large partitions can be split: a common passage has the same surroundings
    again = inner.join(inner.groupBy("around").agg(F.min("doc_id").alias("least")), "around")
    again = _taken_apart(stored(again))
    halves = _with_parts(rows, again.where("least = doc_id")).mapInArrow(_middle_round(span, gram), _ROW)
    same_half = Window.partitionBy("gram")
    several = (F.bit_or(kind).over(same_half).bitwiseAND(_SHARED) > 0) | (F.min("doc_id").over(same_half) < F.max("doc_id").over(same_half))
    halves = halves.select("doc_id", "place", ((kind.bitwiseAND(3) == INNER) | several).alias("open"))
    halves = _taken_apart(stored(halves.where("open").select("doc_id", "place", F.lit(0).cast("long").alias("around"))))
    pairs = _with_parts(rows, halves).mapInArrow(_last_round(span), _ROW)
    pairs = pairs.withColumn("least", F.min("doc_id").over(Window.partitionBy("gram", "around")))
    pairs = stored(pairs.where((_bits("place", _KIND_AT, 62) == DONE) | (F.col("least") < F.col("doc_id"))).select("around", "doc_id", "place"))
    kept = ("doc_id", "tag", "begin", "n")
    return done.select(*kept).unionByName(again.where("least < doc_id").select(*kept)).unionByName(_taken_apart(pairs).select(*kept))


def _with_parts(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """doc_id, tag, raw, parts: the texts with their starts, packed as `_parts` reads them; others are left out."""
    packed = F.shiftleft("begin", 16).bitwiseOR(F.shiftleft("at", 8)).bitwiseOR(F.col("n").cast("long"))
    parts = starts.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set(packed)).alias("parts"))
    return rows.join(parts, ["doc_id", "tag"]).select("doc_id", "tag", "raw", "parts")


def _cut(docs: DataFrame, rows: DataFrame, span: int) -> DataFrame:
    """`rows` (of `_prepared`, and whatever they carry) with begins and ns of the starts to remove; null without any."""
    lists = repeated_starts(docs, span).groupBy("doc_id", "tag").agg(F.collect_list("begin").alias("begins"), F.collect_list("n").alias("ns"))
    return rows.join(lists, ["doc_id", "tag"], "left")


def _left(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    borders = [0, *(x for run in runs for x in run), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (begin and end of each maximal removed run of bytes), kept (bytes).

    One row for each row of `docs`. `span` may be 32 to 79. Null texts are empty. Rows with a null id lose nothing and count for no other;
    rows that share an id are the same document and do not count for each other. Texts shorter than `span` lose
    nothing. Other columns are ignored; an empty table gives an empty result.
    """
    rows = _prepared(docs, id_col, text_col)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw"):
            raws = part.column("raw").to_pylist()
            runs = [joined(b or [], n or [], span) for b, n in zip(part.column("begins").to_pylist(), part.column("ns").to_pylist(), strict=True)]
            columns = {
                "doc_id": part.column("doc_id"),
                "n_bytes": pa.array(list(map(len, raws)), pa.int64()),
                "n_removed": pa.array([sum(b - a for a, b in own) for own in runs], pa.int64()),
                "n_spans": pa.array(list(map(len, runs)), pa.int64()),
                "spans": pa.array([[{"begin": a, "end": b} for a, b in own] for own in runs], kind),
                "kept": pa.array(list(map(_left, raws, runs)), pa.binary()),
            }
            yield pa.record_batch(columns)

    placed = _cut(rows, rows, span).select("doc_id", "raw", "begins", "ns")
    return placed.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<begin: long, end: long>>, kept binary")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """The rows of `docs`, all columns, with the text that `removals` keeps; characters cut through are dropped whole.

    A text that loses nothing stays as it is, also a null one.
    """
    rows = _prepared(docs, id_col, text_col)
    carried = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    carried = carried.select("row", *_columns(f"row.`{id_col}`", f"row.`{text_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw"):
            texts = []
            for raw, begins, ns, text in zip(*(part.column(c).to_pylist() for c in ("raw", "begins", "ns", "text")), strict=True):
                texts.append(_left(raw, joined(begins, ns, span)).decode("utf-8", "ignore") if begins else text)
            out = part.column("row").flatten()
            names = [f.name for f in part.column("row").type]
            out[names.index(text_col)] = pa.array(texts, pa.string())
            yield pa.record_batch(out, names)

    placed = _cut(rows, carried, span).select("row", "raw", "begins", "ns", F.col(f"row.`{text_col}`").alias("text"))
    return placed.mapInArrow(run, docs.schema)


def joined(begins: list[int], ns: list[int], span: int) -> list[tuple[int, int]]:
    """Runs of bytes that the strings at these starts cover; runs that touch are one."""
    runs: list[tuple[int, int]] = []
    for begin, n in sorted(zip(begins, ns, strict=True)):
        end = begin + n - 1 + span
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((begin, end))
    return runs


def brute_force(texts: dict[int, bytes], span: int) -> dict[int, str]:
    """sha256 of what is left of each text, by a plain dictionary of all strings. For small tests."""
    least: dict[bytes, int] = {}
    for doc in sorted(texts):
        for i in range(len(texts[doc]) - span + 1):
            least.setdefault(texts[doc][i : i + span], doc)
    out = {}
    for doc, raw in texts.items():
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - span + 1):
            if least[raw[i : i + span]] < doc:
                gone[i : i + span] = True
        out[doc] = hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()
    return out
