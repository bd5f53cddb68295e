import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from featureflow.llm import common, packing, queries, token_counts, token_files, tokens

PATH = queries.tokenizer_file()
AWKWARD = [
    "", " ", "\n\t", "a", "Hello, World!", "don't they've I'LL we'd it's", "x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|> <|endoftext", "a<|endoftext|>",
    "ÀÉÎõü ÄÖÜ straße ǅ ŉ İstanbul ıI", "Σίσυφος ΟΔΟΣ", "日本語のテキスト。漢字", "é café ́x", "ﬁ ﬀ Å K", "1234 ½ ² ٣ Ⅷ", "a b c　d", "x\x1cy\x85z\x00w\x7f",
    "🙂🙂 👩‍👩‍👧", "__init__ a_b", "'''s 'S ’s", "​zero­width", "endİ", "ſ µ ª º", "w" * 500, "a1b2 c!?d...", "﻿bom", "mixé😀d",
]


@pytest.fixture(scope="module")
def library():
    return tokens.load(PATH)


def texts(seed: int) -> list[str]:
    r = random.Random(seed)
    letters = "abcdeé ÉßABC  '’.,!<|>\n\t0129½ŉİΣ漢́ 😀"
    return AWKWARD + ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(300)] + [" ".join(AWKWARD)]


def test_pieces_encode_as_whole_texts(library):
    for seed in range(5):
        own = texts(seed)
        ids, offsets = tokens.PieceEncoder(PATH).encode(pa.array(own), 1)
        for text, a, b in zip(own, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_counts_equal_the_library(library):
    whole = token_counts.prove(PATH)
    assert len(whole) > 10_000
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in random.Random(1).sample(sorted(whole), 500))
    for seed in range(5):
        own = texts(seed)
        counts = token_counts.Counter(PATH, whole).texts(pa.array(own))
        assert counts.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in own]


def test_memory_starts_anew(library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 3)
    encoder, own = tokens.PieceEncoder(PATH), texts(1)
    for _ in range(3):
        ids, offsets = encoder.encode(pa.array(own))
        assert ids.tolist() == [i for t in own for i in library.encode(t, add_special_tokens=False).ids]


def test_most_used_words_stay(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    encoder, own = tokens.PieceEncoder(PATH), texts(2)
    for text in [*own, *["often"] * 3, *own]:
        ids, _ = encoder.encode(pa.array([text, "often"]), 1)
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1, *library.encode("often").ids, 1]
        assert len(encoder.known) <= 10 and "often" in encoder.known.to_pylist()


def test_capitals_with_distant_small_letters(library):
    own = [f"a{chr(c)}{chr(c)}b" for c in range(0x180, 0x250)]
    ids, offsets = tokens.PieceEncoder(PATH).encode(pa.array(own))
    for text, a, b in zip(own, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == library.encode(text).ids, text


def test_tasks_of_a_worker_share_words():
    first = pickle.loads(cloudpickle.dumps(tokens.encoder))(PATH)  # as a task gets it
    first.encode(pa.array(["sharedworderful"]))
    second = pickle.loads(cloudpickle.dumps(tokens.encoder))(PATH)
    assert second is first and "sharedworderful" in second.known.to_pylist()


def test_lists_are_cut_by_bytes():
    rows = pa.record_batch([pa.array([[1] * 5, [2] * 5, None, [], [3] * 50], pa.list_(pa.int32()))], ["ids"])
    assert [part.num_rows for part in common.slices(iter([rows]), "ids", 40)] == [4, 1]


ROWS = [(5, "Some words here", 1), (5, "Some words here", 2), (None, "no id", 3), (2, None, 4), (9, "", 5), (7, "tail " * 3000, 6), (-4, "first", 7)]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, ids int").withColumnRenamed("ids", "n_tokens").repartition(3)


def test_count_rows(spark, library):
    got = token_counts.count_tokens(frame(spark), PATH, limit=100).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ROWS]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert token_counts.count_tokens(frame(spark).limit(0), PATH).count() == 0


def test_files_round_trip(spark, library, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(frame(spark), path, PATH)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    start = 0
    for r, (_, text, _) in zip(got, order, strict=True):
        assert r["ids"] == [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        start += len(r["ids"])
    one = token_files.checksums(token_files.read_tokens(spark, path, "doc_id = 7")).collect()
    assert [(r["doc_id"], r["ids_crc32"]) for r in one] == [(7, zlib.crc32(np.array(got[-2]["ids"], "<u4").tobytes()))]
    plan = token_files.read_tokens(spark, path, "doc_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan orc") == 1  # the positions come from the side table
    plan = token_files.read_tokens(spark, path, "doc_id = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)" in plan


def test_no_rows_no_files_content(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(frame(spark).limit(0), path, PATH)
    assert token_files.read_tokens(spark, path).count() == 0


@pytest.mark.parametrize("window", [1, 7, 2048])
def test_packing(spark, library, window):
    pieces = packing.pack(frame(spark), PATH, window=window).collect()
    documents = sorted([*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t, _ in ROWS)
    place: dict[int, list] = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        own = place.setdefault(p["sequence_id"], [])
        assert p["offset"] == len(own) and p["length"] == len(p["ids"]) > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        own += p["ids"]
    assert sorted(place) == list(range(len(place)))
    assert all(len(own) == window for s, own in place.items() if s < len(place) - 1)
    flat, found = [i for s in sorted(place) for i in place[s]], []
    heads = sorted((p["sequence_id"] * window + p["offset"], p["doc_tokens"]) for p in pieces if p["start"] == 0)
    for at, n in heads:
        found.append(flat[at : at + n])
    assert sorted(found) == documents and len(flat) == sum(map(len, documents))


def test_sequences_are_padded(spark):
    rows = packing.sequences(packing.pack(frame(spark), PATH, window=50), 50, pad_id=0).collect()
    assert all(len(r["ids"]) == 50 for r in rows)
    assert sum(b["length"] for r in rows for b in r["boundaries"]) == sum(len(r["ids"]) for r in rows) - next(50 - sum(b["length"] for b in r["boundaries"]) for r in sorted(rows, key=lambda r: -r["sequence_id"]))
    assert packing.pack(frame(spark).limit(0), PATH).count() == 0
