"""Near-duplicate documents: MinHash with tensored banding, every link verified on full shingle sets.

Two collections of `SIDE` short tuples of minhashes are made for each document; a table key joins one tuple of either
collection, so SIDE * SIDE tables cost only 2 * SIDE * WIDTH minhashes. Two documents meet if they agree on a tuple of
each collection: at similarity s with probability (1 - (1 - s^WIDTH)^SIDE)^2, above 0.9996 at 0.8. A tuple that
no other document has cannot meet, so only shared tuples are combined. Documents with equal sets are one class from
the start and only its least id is compared.

A bucket's pairs are never listed. First each member is compared with the least member of its buckets, which joins
groups of copies in one step. Then only buckets that still hold several components are looked at, in blocks of bounded
size. A pair is looked at in the first table that its documents share, and leaves it if it joins two components, the
sizes allow the similarity and so does a sketch of `BINS` bins, which is `DEVIATIONS` standard deviations below the
limit for fewer than one in ten thousand links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm import tokens
from featureflow.llm.common import slices, stored, texts_of
from featureflow.llm.components import components

#: Tuples in either collection, and minhashes in a tuple.
SIDE = 12
WIDTH = 3
#: Bins of the sketch that tells which pairs to verify, a byte each; its allowance in standard deviations.
BINS = 512
DEVIATIONS = 4.0
#: Members of a bucket compared at once; larger buckets are compared block by block.
SMALL_BUCKET = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all texts' word shingles, with repeats; offsets of the texts in them).

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text of fewer than `width` words is one
    shingle, one without words none.
    """
    offsets, distinct, codes = tokens.pieces_of(pc.ascii_lower(texts))
    names = distinct.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(n) for n in names], np.uint64)
    real = np.array([n != "" for n in names], bool)[codes] if names else np.zeros(0, bool)
    offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
    words = hashes[codes[real]]
    counts = np.diff(offsets)
    made = np.maximum(counts - width + 1, np.minimum(counts, 1))
    ends = np.cumsum(made)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(offsets[:-1] - (ends - made), made)
    own = np.repeat(np.minimum(counts, width), made)  # words in the shingle
    out = own.astype(np.uint64)
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    for j in range(width):
        out = np.where(own > j, mixed(out * _MIX + padded[place + j]), out)
    return out, np.concatenate(([0], ends))


def tuples(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """documents x 2 * SIDE tuples, each a 32-bit mix of WIDTH minhashes, for documents that all have shingles."""
    seeds = mixed(np.arange(1, 2 * SIDE * WIDTH + 1, dtype=np.uint64) * _MIX).astype(np.uint32).reshape(2 * SIDE, WIDTH)
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    scattered, shifted = np.empty_like(short), np.empty_like(short)
    out = np.zeros((2 * SIDE, len(offsets) - 1), np.uint64)
    for t in range(2 * SIDE):
        for seed in seeds[t]:
            np.bitwise_xor(short, seed, out=scattered)
            scattered *= seed | np.uint32(1)
            np.right_shift(scattered, np.uint32(15), out=shifted)
            scattered ^= shifted
            scattered *= np.uint32(0x85EBCA6B)
            out[t] = mixed(out[t] * _MIX + np.minimum.reduceat(scattered, offsets[:-1]))
    return (out >> np.uint64(32)).astype(np.uint32).T


def sketch(hashes: np.ndarray) -> bytes:
    """One byte for each bin of a sorted set of hashes: of the least hash in it, or 0 for an empty bin."""
    bins = (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out = np.zeros(BINS, np.uint8)
    out[bins[first]] = hashes[first] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def _sketches(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, print (16 bytes that stand for the set), tuples (left, then right), sketch; null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes, offsets = shingles(part.column("text"), width)
            sets = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            some = np.flatnonzero(np.diff(offsets))
            made = tuples(hashes, offsets[np.append(some, len(offsets) - 1)]) if len(some) else np.zeros((0, 2 * SIDE), np.uint32)
            place = np.full(len(sets), len(some))
            place[some] = np.arange(len(some))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * 2 * SIDE), pa.array(made.ravel().view(np.int32)))
            prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), flat.take(pa.array(place, mask=place == len(some)))]
            columns.append(pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()))
            yield pa.record_batch(columns, ["doc_id", "n_shingles", "print", "tuples", "sketch"])

    return rows.mapInArrow(run, "doc_id long, n_shingles long, print binary, tuples array<int>, sketch binary")


def _hits(classes: DataFrame) -> DataFrame:
    """rep, lefts, rights: (number, hash) of the tuples of each collection that other classes have too."""
    rows = classes.select("rep", F.posexplode("tuples").alias("i", "x")).select("rep", "i", F.xxhash64("i", "x").alias("hash"))
    common = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    met = rows.join(common, "hash", "left_semi").groupBy("rep")
    left, one = F.col("i") < SIDE, F.struct("i", "hash")
    lists = met.agg(F.collect_list(F.when(left, one)).alias("lefts"), F.collect_list(F.when(~left, one)).alias("rights"))
    return lists.where((F.size("lefts") > 0) & (F.size("rights") > 0))


def _met(hits: DataFrame) -> DataFrame:
    """key, rep, place (of the table), head: the members of each table's buckets of two or more, with the least one."""
    rows = hits.select("rep", "rights", F.explode("lefts").alias("l")).select("rep", "l", F.explode("rights").alias("r"))
    keys = rows.select(F.xxhash64("l.hash", "r.hash").alias("key"), "rep", (F.col("l.i") * SIDE + F.col("r.i") - SIDE).cast("short").alias("place"))
    heads = keys.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last")
    return keys.join(heads.select("key", "head"), "key")


def _likely(size_a: np.ndarray, size_b: np.ndarray, sketch_a: np.ndarray, sketch_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar enough, and their sketches allow it."""
    out = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    look = np.flatnonzero(out)
    a, b, share = sketch_a[look], sketch_b[look], percent / 100
    used = ((a > 0) | (b > 0)).sum(1)
    united = np.maximum((size_a[look] + size_b[look]) / (1 + share), used)  # at the limit; the sketch holds `used` of them
    spread = DEVIATIONS * np.sqrt(share * (1 - share) / used * (1 - used / united)) + 1 / used
    out[look] = ((a == b) & (a > 0)).sum(1) >= (share - spread) * used
    return out


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not exclude."""
    sides = [classes.select(F.col("rep").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            near = _likely(*(part.column(f"size_{x}").to_numpy() for x in "ab"), *(_sketch_rows(part.column(f"sketch_{x}")) for x in "ab"), percent)
            yield part.select(["a", "b"]).filter(pa.array(near))

    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    return joined.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _bucket_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (a, b) of different components in a bucket, each in the first table that both are in.

    members: key, x, y (blocks that meet), block, place, rep, component, size, tuples, sketch, sorted by (key, x, y). A
    group has at most two blocks, so it fits into memory.
    """

    def pairs(group: pa.Table) -> pa.RecordBatch:
        rep, component, size, block = (group[c].to_numpy() for c in ("rep", "component", "size", "block"))
        own = group["tuples"].combine_chunks().flatten().to_numpy().reshape(-1, 2 * SIDE)
        sketches, cross = _sketch_rows(group["sketch"].combine_chunks()), group["x"][0] != group["y"][0]
        i, j = divmod(group["place"][0].as_py(), SIDE)
        earlier = [*range(i), *range(SIDE, SIDE + j)]
        a, b = [], []
        for begin in range(0, len(rep), 128):
            rows = slice(begin, begin + 128)
            fit = (component[rows, None] != component) & (rep[rows, None] > rep)
            if cross:
                fit &= block[rows, None] != block
            x, y = np.nonzero(fit)
            x += begin
            for t in earlier:
                fresh = own[x, t] != own[y, t]
                x, y = x[fresh], y[fresh]
            near = _likely(size[x], size[y], sketches[x], sketches[y], percent)
            a.append(rep[x[near]])
            b.append(rep[y[near]])
        return pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch])
            held = held if rest is None else pa.concat_tables([rest, held])
            marks = [held[c].to_numpy() for c in ("key", "x", "y")]
            fresh = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], 0)) + 1
            borders = [0, *fresh.tolist()]
            for begin, end in zip(borders, borders[1:], strict=False):
                yield pairs(held.slice(begin, end - begin))
            rest = held.slice(borders[-1])
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    return members.mapInArrow(run, "a long, b long").distinct()


def _late_pairs(met: DataFrame, classes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs worth verifying in buckets that still hold several components."""
    placed = met.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "place", F.coalesce("component", "rep").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    several = several.select("key", F.ceil(F.col("n") / SMALL_BUCKET).cast("int").alias("blocks"))
    members = placed.join(several, "key").join(classes.select("rep", "size", "tuples", "sketch"), "rep")
    members = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "place", "rep", "component", "size", "tuples", "sketch")
    return _bucket_pairs(members.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y"), percent)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough: 100 * common >= percent * united."""
    pairs = stored(pairs)
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    needed = stored(texts.join(ends, "doc_id", "left_semi"))
    joined = pairs.join(needed.withColumnRenamed("doc_id", "a"), "a")
    joined = joined.join(needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            both = []
            for column in ("text", "text_b"):
                coded = part.column(column).dictionary_encode()  # a text that is in many pairs is taken apart once
                hashes, offsets = shingles(coded.dictionary, width)
                sets = [np.unique(hashes[x:y]) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
                both.append([sets[i] for i in coded.indices.to_pylist()])
            common = np.array([len(np.intersect1d(x, y, True)) for x, y in zip(*both, strict=True)], np.int64)
            united = np.array([len(x) + len(y) for x, y in zip(*both, strict=True)], np.int64) - common
            yield part.select(["a", "b"]).filter(pa.array(100 * common >= percent * united))

    return joined.select("a", "b", "text", "text_b").mapInArrow(run, "a long, b long").distinct()


def _same_id(classed: DataFrame) -> DataFrame:
    """Links between classes that hold rows of the same id. classed: doc_id, rep."""
    ids = classed.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last")
    return classed.join(ids.select("doc_id", "b"), "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the least id that links lead to, or its own), kept; one row for each row of `docs`.

    Two documents are linked if their sets of word shingles have 100 * common >= percent * united; see `shingles` for
    words. Null, empty and wordless texts have an empty set and no links. Rows with a null id are kept, with no
    component, and link nothing. Rows that share an id are one document: their sets' links are all its links. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = texts_of(docs, id_col, text_col)
    sketches = stored(_sketches(rows, width))
    named = sketches.where("print is not null and doc_id is not null")
    least = named.groupBy("print").agg(F.min(F.struct("doc_id", "n_shingles", "tuples", "sketch")).alias("c"))
    classes = stored(least.select("print", F.col("c.doc_id").alias("rep"), F.col("c.n_shingles").alias("size"), "c.tuples", "c.sketch"))
    met = stored(_met(stored(_hits(classes))))
    stars = met.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    classed = sketches.join(classes.select("print", "rep"), "print", "left")
    same = _same_id(classed.where("doc_id is not null and rep is not null").select("doc_id", "rep"))
    links = stored(verified(_plausible(stars, classes, percent), rows, width, percent).unionByName(same))
    found = components(links)
    late = stored(verified(_late_pairs(met, classes, found, percent), rows, width, percent))
    if not late.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late))
    joined = classed.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("node")).join(found, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    joined = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
