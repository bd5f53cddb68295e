import random

import numpy as np
import pytest

from featureflow.llm import periodic
from featureflow.llm.queries import QUERIES, planted_repeats

SF = "/root/testdata/sf0.001"


def plain_runs(words: list, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """Every period, every stretch that keeps it; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words: list, runs: list) -> list:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def repetitive(r: random.Random) -> list[int]:
    k, words = r.choice([1, 2, 2, 3, 5, 20]), []
    for _ in range(r.randint(0, 8)):
        own = [r.randrange(k) for _ in range(r.randint(1, 12))]
        words += own if r.random() < 0.5 else (own[:6] * r.randint(2, 7))[: -r.randint(1, len(own))]
    return words


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 5), (5, 2), (2, 9)])
def test_runs_equal_every_stretch(exponent, least):
    r = random.Random(exponent * 100 + least)
    for _ in range(400):
        words = repetitive(r)
        want = plain_runs(words, exponent, least)
        assert periodic.runs_of(words, exponent, least) == want
        first, last = periodic.islands(np.array(words, np.int64), np.array([0, len(words)]), exponent, least)
        assert sorted((start + a, n, q) for a, b in zip(first, last, strict=True) for start, n, q in periodic.runs_of(words[a:b], exponent, least)) == want


def test_prose_is_passed_over():
    r = np.random.default_rng(3)
    first, last = periodic.islands(r.integers(0, 2000, 50_000), np.array([0, 20_000, 50_000]), 4, 6)
    assert (last - first).sum() < 200


def test_whole_texts(spark):
    r = random.Random(8)
    texts = [" ".join(f"w{x}" for x in repetitive(r)) for _ in range(300)]
    texts += ["a\tb\na  b\x0ba b\x0ca b\r ", "a b a b a b a b a b a b", "\x1ca " * 7, "é " * 30, "", " \n", None, "x y " * 50_000, "z" * 300_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "u u u u u u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as runs", "2 as period").repartition(5)
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by = {x["doc_id"]: x for x in got}
    assert [tuple(x) for x in by[None]["runs"]] == [(0, 6, 1)] and by[None]["collapsed"] == "u"
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        want = plain_runs(words) if len(words) < 1000 else [(0, len(words), 2)]
        assert [tuple(x) for x in by[i]["runs"]] == want and by[i]["n_words"] == len(words)
        assert by[i]["collapsed"].encode() == b" ".join(collapsed(words, want))
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, exponent=1)


def test_query_equals_a_plain_version(spark):
    import hashlib
    import zlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc in docs:
        words, h = (doc["text"] or "").encode().split(), zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(runs) and (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()
    assert planted > 5


def test_planted_repeats_leave_other_texts_alone(spark):
    docs = spark.createDataFrame([(None, "a  b"), (1, None), (2, " x\ny "), (3, "")], "doc_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in planted_repeats(docs).collect() if r["doc_id"] != 2} >= {(None, "a  b"), (1, ""), (3, "")}
