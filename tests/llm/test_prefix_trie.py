import hashlib
import random
import zlib

import numpy as np
import pytest

from featureflow.llm import prefix_trie
from featureflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(convs: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    members, children, ends = {}, {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in own) if own else 1
        saved[node] = sum(saved[x] for x in own) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return {
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, m in members.items()
    }


def conversations(seed: int, n: int, long: int = 0) -> dict[int, list[tuple[str, str]]]:
    r, out = random.Random(seed), {}
    for c in r.sample(range(-500, 3000), n):
        old = list(out.values())
        turns = list(r.choice(old)) if old and r.random() < 0.7 else []
        turns = turns[: r.randint(0, len(turns))] if r.random() < 0.6 else turns
        turns += [(r.choice(["user", "bot", ""]), r.choice(["", "hi", "é😀", "so", "why not?"])) for _ in range(r.choice([0, 0, 1, 2, 5]))]
        out[c] = turns
    for c in range(long):
        out[10_000 + c] = [("user", str(i % 3)) for i in range(200 + 7 * c)] + [("bot", str(c))] * c
    return out


def frames(spark, convs, parts=6):
    rows = [(c, i * 3 - 4, role or None, text or None) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    rows = [(c, None if t == -4 else t, role, text) for c, t, role, text in rows]  # nulls come first
    random.Random(1).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    return turns, spark.createDataFrame([(c,) for c in convs], "conv_id long")


def result(frame) -> set[tuple]:
    rows = [tuple(r[c] for c in COLUMNS) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_trie_equals_a_plain_one(spark):
    convs = conversations(1, 250)
    turns, ids = frames(spark, convs)
    turns = turns.selectExpr("*", "1 as depth", "'x' as digest", "2 as k1", "3 as size")
    assert result(prefix_trie.prefix_trie(turns, convs=ids)) == plain_trie(convs)
    with_turns = {c: t for c, t in convs.items() if t}
    assert result(prefix_trie.prefix_trie(turns)) == plain_trie(with_turns)


def test_cut_conversations_and_many_shards(spark, monkeypatch):
    """Long conversations pass through several tasks, segments and shards."""
    for name, value in {"SEGMENT": 16, "SHARD_ROWS": 300, "NEAR": 2, "PIECE_IDS": 3}.items():
        monkeypatch.setattr(prefix_trie, name, value)
    convs = conversations(2, 120, long=9)
    turns, ids = frames(spark, convs)
    assert result(prefix_trie.prefix_trie(turns, convs=ids)) == plain_trie(convs)


def test_one_conversation_holds_most_turns(spark):
    convs = {7: [("a", "x")] * 3000 + [("b", str(i)) for i in range(3000)], 8: [("a", "x")] * 40, 9: []}
    turns, ids = frames(spark, convs)
    assert result(prefix_trie.prefix_trie(turns, convs=ids)) == plain_trie(convs)
    numbered = prefix_trie.numbered(prefix_trie.turn_digests(turns))
    assert numbered.where("conv_id = 7").selectExpr("min(depth)", "max(depth)", "count(distinct depth)").head()[:] == (1, 6000, 6000)


def test_ties_nulls_and_empty_tables(spark):
    rows = [(1, 5, "u", "b"), (1, 5, "u", "a"), (1, None, "u", "n"), (2, 5, "u", "a"), (2, 5, "u", "b"), (2, None, "u", "n"), (None, 1, "u", "z"), (3, 0, None, None), (3, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    order = sorted([("u", "a"), ("u", "b")], key=lambda x: hashlib.sha256(f"{len(x[0])}:{x[0]}{x[1]}".encode()).digest())
    convs = {c: [("u", "n"), *order] for c in (1, 2)} | {3: [("", "")] * 2}
    assert result(prefix_trie.prefix_trie(turns)) == plain_trie(convs)
    assert prefix_trie.prefix_trie(turns.limit(0)).count() == 0


def test_clashing_digests_are_noticed(spark):
    turns, ids = frames(spark, {1: [("a", "x"), ("b", "y")], 2: [("b", "y"), ("a", "x")]})
    zero = ((0, 0), prefix_trie._BASES[1])  # with base 0 every name is 0
    assert result(prefix_trie.trie(prefix_trie.turn_digests(turns), ids, zero)) == plain_trie({1: [("a", "x"), ("b", "y")], 2: [("b", "y"), ("a", "x")]})
    with pytest.raises(ValueError):
        prefix_trie.trie(prefix_trie.turn_digests(turns), ids, zero[:1])


def test_slots_are_minimal_and_tell_strangers():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 100, 20_000):
        digests = r.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        slots = prefix_trie.Slots(digests)
        assert sorted(slots.of(digests).tolist()) == list(range(n))
        assert (slots.of(digests + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.Slots(np.ones((2, 2), np.uint64))


def test_query_equals_a_plain_version(spark):
    own = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        own.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    assert result(QUERIES["op11_prefix_trie"](spark, SF)) == plain_trie(rebuilt)
