"""The trie of conversations' beginnings: which turns are shared, by how many, and what sharing them saves.

A node is a distinct sequence of first turns. Its name is a digest of two 64-bit words, the sums over its turns of a
turn's hash times a base to the power of its number: prefix sums, so that not even one conversation must pass through
one task. Equal names are checked to stand for equal last turns, depths and parents.

Nodes, members and children are counted by grouping on the digests. What a node's subtree holds is summed in shards,
each with the paths of some conversations: the distinct digests get slots by a minimal perfect hash, whose table holds
the digests and so tells strangers; the values are scattered into flat arrays, and parent slots carry them upwards,
depth by depth. A node's values stand in the path of its smallest member alone, so the shards' sums add up. Shards are
bounded: a conversation longer than SEGMENT turns is cut, and what lies below a cut enters at its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import stored

#: Rows a shard has at most about, conversations whose ids are near each other and go to the same one, and turns that stay together.
SHARD_ROWS = 200_000
NEAR = 64
SEGMENT = 4096
#: Conversation ids joined into one piece of text before a node's ids are hashed.
PIECE_IDS = 2048

#: Odd, one for each word of a digest; further pairs are taken if digests ever clash.
_BASES = ((0xD6E8FEB86659FD93, 0xA0761D6478BD642F), (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3), (0x589965CC75374CC3, 0x1D8E4E27C47D124F))
_WORD = (1 << 64) - 1
_EMPTY = hashlib.sha256().hexdigest()

_NUMBERED = "conv_id long, depth long, digest binary, size long, k1 long, k2 long, p1 long, p2 long"


def turn_digests(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, digest (SHA-256 of role and text), size (code points of the text). Null roles and texts are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.char_length(text).cast("long").alias("size"),
    )


def _powers(base: int, n: np.ndarray) -> np.ndarray:
    """base ** n in 64-bit words, by squaring."""
    out, factor, n = np.ones(len(n), np.uint64), base, n.copy()
    while n.any():
        odd = (n & 1) == 1
        out[odd] *= np.uint64(factor)
        factor, n = factor * factor & _WORD, n >> 1
    return out


def _words(digests: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)[:, :2].astype(np.uint64)


def _offsets(edges: list[Any], bases: tuple[int, int]) -> dict[int, tuple[int, int, int, int]]:
    """part: (its first conversation, turns before, digest before), for parts that go on with a conversation.

    edges: for each part its last conversation, and its first if that is another, with their turns and sums there.
    """
    out: dict[int, tuple[int, int, int, int]] = {}
    conv, n, k1, k2 = None, 0, 0, 0
    for e in sorted(edges, key=lambda e: (e["part"], e["conv_id"])):
        if e["conv_id"] == conv:
            out[e["part"]] = (conv, n, k1, k2)
        else:
            conv, n, k1, k2 = e["conv_id"], 0, 0, 0
        k1 = k1 + pow(bases[0], n, 1 << 64) * (e["k1"] & _WORD) & _WORD
        k2 = k2 + pow(bases[1], n, 1 << 64) * (e["k2"] & _WORD) & _WORD
        n += e["n"]
    return out


def numbered(turns: DataFrame, bases: tuple[int, int] = _BASES[0]) -> DataFrame:
    """conv_id, depth (1, 2, ... in the order of turns), digest, size, k1 and k2 (the prefix), p1 and p2 (the prefix before).

    Turns that tie are ordered by their digests. Rows are sorted over all tasks and numbered in each; a conversation
    that goes on in the next task is continued there from the sums of the tasks before it, two of which each task
    reports to the driver.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    copies = F.monotonically_increasing_id()  # identical rows may be cut apart, too
    rows = turns.withColumn("copy", copies).repartitionByRange(*order, "copy").sortWithinPartitions(*order, "copy").select("conv_id", "digest", "size")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = ["conv_id", "digest", "size", "part", "edge", "n", "k1", "k2"]

        def batch(conv: np.ndarray, digest: pa.Array, size: pa.Array, edge: bool, n: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
            m = len(conv)
            return pa.record_batch([pa.array(conv), digest, size, pa.array(np.full(m, part, np.int32)), pa.array(np.full(m, edge)), pa.array(n), *(pa.array(s.view(np.int64)) for s in sums)], names)

        first, last = None, (None, 0, [np.uint64(0)] * 2)  # conversation, turns and sums so far
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column("conv_id").to_numpy()
            begins = np.concatenate(([True], conv[1:] != conv[:-1]))
            group = np.cumsum(begins) - 1
            at = np.flatnonzero(begins)
            n = np.arange(len(conv)) - at[group] + 1
            goes_on = conv[0] == last[0]
            if goes_on:
                n[group == 0] += last[1]
            words, sums = _words(b.column("digest")), []
            for w, base in enumerate(bases):
                total = np.cumsum(words[:, w] * _powers(base, n))
                total -= np.concatenate((np.zeros(1, np.uint64), total))[at][group]
                if goes_on:
                    total[group == 0] += last[2][w]
                sums.append(total)
            if first is None:
                first = (conv[0], 0, None)
            if first[2] is None and (len(at) > 1 or conv[0] != first[0]):  # the first conversation has ended
                end = at[1] - 1 if conv[0] == first[0] else -1
                first = (first[0], int(n[end]), [s[end] for s in sums]) if end >= 0 else (first[0], last[1], last[2])
            last = (conv[-1], int(n[-1]), [s[-1] for s in sums])
            yield batch(conv, b.column("digest"), b.column("size"), False, n, sums)
        if first is not None:
            edges = [last] if first[2] is None else [first, last]
            nothing = [pa.nulls(len(edges), t) for t in (pa.binary(), pa.int64())]
            yield batch(np.array([e[0] for e in edges]), *nothing, True, np.array([e[1] for e in edges]), [np.array([e[2][w] for e in edges], np.uint64) for w in (0, 1)])

    counted = stored(rows.mapInArrow(count, "conv_id long, digest binary, size long, part int, edge boolean, n long, k1 long, k2 long"))
    offsets = _offsets(counted.where("edge").select("part", "conv_id", "n", "k1", "k2").collect(), bases)  # two rows for each task

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, n, parts = (b.column(c).to_numpy() for c in ("conv_id", "n", "part"))
            sums = [b.column(c).to_numpy().astype(np.uint64) for c in ("k1", "k2")]
            n = n.copy()
            for part in np.unique(parts).tolist():
                if part in offsets:
                    whose, before, *old = offsets[part]
                    on = (parts == part) & (conv == whose)
                    for s, base, k in zip(sums, bases, old, strict=True):
                        s[on] = np.uint64(k) + s[on] * np.uint64(pow(base, before, 1 << 64))
                    n[on] += before
            words = _words(b.column("digest"))
            parents = [s - words[:, w] * _powers(base, n) for w, (s, base) in enumerate(zip(sums, bases, strict=True))]
            numbers = [pa.array(x.view(np.int64)) for x in (*sums, *parents)]
            yield pa.record_batch([b.column("conv_id"), pa.array(n), b.column("digest"), b.column("size"), *numbers], [f.split()[0] for f in _NUMBERED.split(", ")])

    return counted.where("not edge").select("conv_id", "digest", "size", "part", "n", "k1", "k2").mapInArrow(place, _NUMBERED)


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * seed)
    return x ^ (x >> np.uint64(27))


class Slots:
    """A minimal perfect hash of distinct digests (n x 2 words): 0 to n - 1, each once; strangers get -1.

    Level by level, digests are hashed into a table of a bit more than their number; those alone in their place stay,
    and their slots are their ranks among all that stay; the others go to the next level.
    """

    def __init__(self, digests: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, int]] = []  # for each: which places are taken, as ranks; slots before it
        left, before = digests, 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("digests are not distinct")
            place = self._place(left, len(self.levels), self._size(len(left)))
            alone = np.bincount(place, minlength=self._size(len(left))) == 1
            self.levels.append((np.where(alone, np.cumsum(alone) - 1, -1), before))
            before += int(alone.sum())
            left = left[~alone[place]]
        self.digests = np.zeros((before, 2), np.uint64)
        self.digests[self._slot(digests)] = digests

    @staticmethod
    def _size(n: int) -> int:
        return n + n // 4 + 1

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(digests[:, 0] + _mixed(digests[:, 1], 7 * level + 1), level) % np.uint64(size)).astype(np.int64)

    def _slot(self, digests: np.ndarray) -> np.ndarray:
        out, left = np.full(len(digests), -1), np.arange(len(digests))
        for level, (ranks, before) in enumerate(self.levels):
            rank = ranks[self._place(digests[left], level, len(ranks))]
            out[left[rank >= 0]] = rank[rank >= 0] + before
            left = left[rank < 0]
        return out

    def of(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that the table does not hold."""
        if not len(self.digests):
            return np.full(len(digests), -1)
        slot = self._slot(digests)
        return np.where((slot >= 0) & (self.digests[slot] == digests).all(1), slot, -1)


def subtree_sums(digests: np.ndarray, parents: np.ndarray, depth: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct digests, and for each the sums of `values` over its rows and those of the nodes below it.

    Rows of one digest have the same parent and depth. Nothing goes to a parent that is no row's digest, nor out of a
    segment.
    """
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    fresh = np.concatenate(([True], (digests[order[1:]] != digests[order[:-1]]).any(1)))[: len(order)]
    slots = Slots(digests[order[fresh]])
    n, slot = len(slots.digests), slots.of(digests)
    parent, level = np.full(n, -1), np.zeros(n, np.int64)
    parent[slot], level[slot] = np.where(depth % SEGMENT > 0, slots.of(parents), -1), depth
    sums = np.zeros((n, values.shape[1]), np.int64)
    np.add.at(sums, slot, values)
    deep = np.argsort(-level, kind="stable")
    for nodes in np.split(deep, np.flatnonzero(np.diff(level[deep])) + 1):
        inside = nodes[parent[nodes] >= 0]
        np.add.at(sums, parent[inside], sums[inside])
    return slots.digests, sums


def _subtrees(paths: DataFrame, values: DataFrame, rows: int) -> DataFrame:
    """k1, k2, saved_tokens, n_leaves: a shard's part of the sums of a node's subtree; the parts of all shards add up.

    paths: conv_id, depth, k1, k2, p1, p2 for every conversation and depth; values: the same with saved_tokens and
    n_leaves, for the smallest member of each node.
    """
    segment = F.floor(F.col("depth") / SEGMENT)
    columns = ["conv_id", "depth", "k1", "k2", "p1", "p2", "saved_tokens", "n_leaves"]
    empty = paths.select(*columns[:6], F.lit(0).cast("long").alias("saved_tokens"), F.lit(0).cast("long").alias("n_leaves"))
    # the ends of segments, with what their conversation's later segments hold
    ends = empty.where((F.col("depth") + 1) % SEGMENT == 0)
    later = values.where(F.col("depth") >= SEGMENT).groupBy("conv_id", segment.alias("segment")).agg(F.max("depth").alias("depth"), F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rangeBetween(Window.unboundedPreceding, -1)
    cut = ends.withColumn("segment", segment).unionByName(later, allowMissingColumns=True)
    cut = cut.select(*columns[:6], F.sum("saved_tokens").over(below).alias("saved_tokens"), F.sum("n_leaves").over(below).alias("n_leaves"))
    cut = cut.where("k1 is not null and n_leaves is not null").select(columns)

    shards = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SHARD_ROWS))
    shard = F.pmod(F.xxhash64(F.floor(F.col("conv_id") / NEAR), segment), F.lit(shards))
    everything = empty.unionByName(values.select(columns)).unionByName(cut).withColumn("shard", shard)

    def run(table: pa.Table) -> pa.Table:
        digests, parents, sums = (np.stack([table.column(c).fill_null(0).to_numpy().astype(np.uint64 if c[0] in "kp" else np.int64) for c in pair], 1) for pair in (("k1", "k2"), ("p1", "p2"), ("saved_tokens", "n_leaves")))
        names, total = subtree_sums(digests, parents, table.column("depth").to_numpy(), sums)
        some = total.any(1)
        numbers = (*names[some].view(np.int64).T, *total[some].T)
        return pa.table([pa.array(np.ascontiguousarray(x)) for x in numbers], ["k1", "k2", "saved_tokens", "n_leaves"])

    return everything.groupBy("shard").applyInArrow(run, "k1 long, k2 long, saved_tokens long, n_leaves long")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the ids (k1, k2, conv_id) of each node, ascending, joined by commas.

    Sorted over all tasks, joined to pieces there, and the pieces hashed one after another: no node's ids meet in memory.
    """
    key = ["k1", "k2"]
    ordered = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, PIECE_IDS) for i in range(0, b.num_rows, PIECE_IDS)):
                k1, k2, conv = (part.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
                at = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
                ids = list(map(str, conv.tolist()))
                borders = [*at.tolist(), len(ids)]
                texts = [",".join(ids[a:z]) for a, z in zip(borders[:-1], borders[1:], strict=True)]
                yield pa.record_batch([pa.array(k1[at]), pa.array(k2[at]), pa.array(conv[at]), pa.array(texts)], ["k1", "k2", "first", "ids"])

    pieces = ordered.mapInArrow(join, "k1 long, k2 long, first long, ids string")
    pieces = pieces.repartition(*key).sortWithinPartitions(*key, "first")

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            done = []
            for k1, k2, ids in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if (k1, k2) == now:
                    state.update(b"," + ids.encode())
                else:
                    if now:
                        done.append((*now, state.hexdigest()))
                    now, state = (k1, k2), hashlib.sha256(ids.encode())
            yield from batch(done)
        if now:
            yield from batch([(*now, state.hexdigest())])

    def batch(rows: list[tuple[int, int, str]]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.record_batch([pa.array(x) for x in zip(*rows, strict=True)], ["k1", "k2", "ends_sha256"])

    return pieces.mapInArrow(hash_all, "k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, bases: tuple[tuple[int, int], ...] = _BASES) -> DataFrame:
    """The nodes of `prefix_trie` from (conv_id, turn, digest, size), see `turn_digests`, and all conv_ids."""
    key = ["k1", "k2"]
    roots = convs.select(F.col("conv_id").cast("long")).where("conv_id is not null").distinct()
    roots = roots.selectExpr("conv_id", "0L as depth", "0L as size", "0L as k1", "0L as k2", "cast(null as long) as p1", "cast(null as long) as p2", "0L as t1", "0L as t2")
    last = (F.xxhash64("digest").alias("t1"), F.xxhash64(F.lit(1), "digest").alias("t2"))
    paths = stored(numbered(turns, bases[0]).select("conv_id", "depth", "size", "k1", "k2", "p1", "p2", *last).unionByName(roots))
    same = [F.coalesce(F.min(c) == F.max(c), F.lit(True)) for c in ("depth", "size", "p1", "p2", "t1", "t2")]
    found = paths.groupBy(*key).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.max("size").alias("size"), (~reduce(and_, same)).alias("clash"),
    )
    nodes = stored(found)
    rows, clashes = nodes.agg(F.sum("n_convs"), F.sum(F.col("clash").cast("int"))).head()
    if clashes:  # two sequences with one name
        if len(bases) == 1:
            raise ValueError("digests clash under every base")
        return trie(turns, convs, bases[1:])
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    known = stored(nodes.join(children, key, "left").fillna(0, ["n_children"]))
    values = known.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("size")).withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    ends = paths.groupBy("conv_id").agg(F.max_by("k1", "depth").alias("k1"), F.max_by("k2", "depth").alias("k2")).select(*key, "conv_id")
    below = _subtrees(paths, values, rows or 0)
    about = below.withColumn("ends_sha256", F.lit(None).cast("string")).unionByName(_end_hashes(ends), allowMissingColumns=True)
    about = about.groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"))
    above = known.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        known.join(about, key, "left")
        .join(above, ["p1", "p2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
    )


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", convs: DataFrame | None = None) -> DataFrame:
    """One row for each distinct sequence of first turns (role, text) of the conversations, from the empty one (depth 0).

    conv_id (smallest conversation that begins so), depth, parent_conv_id (null for the root), n_convs (conversations
    that begin so), n_children, n_leaves (childless nodes in the subtree, itself included), saved_tokens (over the
    subtree, characters of a node's last turn times its conversations but one), ends_sha256 (of the ids of conversations
    that end here, ascending, joined by commas). (conv_id, depth) names a node.

    Turns are ordered by `turn_col`, nulls first, ties by a SHA-256 of role and text. Null roles and texts are empty;
    repeated rows are turns of their own; rows without a conversation are left out; other columns are ignored. `convs`
    (conv_id) adds conversations without turns. An empty table has no nodes.
    """
    rows = turn_digests(turns, conv_col, turn_col, role_col, text_col)
    all_convs = rows.select("conv_id")
    if convs is not None:
        all_convs = all_convs.unionByName(convs.select(F.col("conv_id").cast("long")))
    return trie(rows, all_convs)
