import hashlib
import random

import numpy as np
import pytest

from featureflow.llm import suffix_dedup as sd


def planted(seed: int, n: int = 60) -> dict[int, str]:
    """Texts of few letters with shared passages, copies, near copies, runs of one letter and non-ASCII letters."""
    r = random.Random(seed)
    letters = "ab cdé\n" if seed % 2 else "abcdefgh ijk lmnop ü"
    passages = ["".join(r.choices(letters, k=r.randint(40, 200))) for _ in range(4)]
    texts: dict[int, str] = {}
    for i in range(n):
        kind = r.random()
        if kind < 0.2 and texts:
            text = r.choice(list(texts.values()))
        elif kind < 0.45 and texts:
            text = r.choice(list(texts.values()))
            at = r.randrange(len(text) + 1)
            text = text[:at] + r.choice(letters) + text[at + r.randrange(2) :]
        else:
            text = "".join(r.choices(letters, k=r.randint(0, 250)))
            for _ in range(r.randrange(3)):
                at = r.randrange(len(text) + 1)
                text = text[:at] + r.choice(passages) + text[at:]
        if kind > 0.95:
            text += "z" * r.randint(30, 400)
        texts[r.randrange(10**6)] = text
    return texts


def left(frame) -> dict[int, str]:
    return {row["doc_id"]: hashlib.sha256(row["kept"]).hexdigest() for row in frame.collect()}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("parts", [1, 5])
def test_equals_brute_force(spark, seed, parts):
    texts = planted(seed)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(parts)
    got = sd.removals(frame).collect()
    want = sd.brute_force({k: v.encode() for k, v in texts.items()}, sd.SPAN)
    assert {r["doc_id"]: hashlib.sha256(r["kept"]).hexdigest() for r in got} == want
    for r in got:
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())
        assert r["n_removed"] == r["n_bytes"] - len(r["kept"]) == sum(s["end"] - s["begin"] for s in r["spans"])
        assert r["n_spans"] == len(r["spans"])
        assert all(a["end"] < b["begin"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


@pytest.mark.parametrize("span", [32, 40, 63, 79])
def test_other_spans_equal_brute_force(spark, span):
    texts = planted(11 + span)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert left(sd.removals(frame, span=span)) == sd.brute_force({k: v.encode() for k, v in texts.items()}, span)


@pytest.mark.parametrize("span", [0, 31, 80, 100])
def test_spans_without_room_are_refused(spark, span):
    with pytest.raises(ValueError, match="span"):
        sd.removals(spark.createDataFrame([(1, "a" * 200)], "doc_id long, text string"), span=span)


def test_small_chunks_and_texts_longer_than_a_block(spark, monkeypatch):
    texts = planted(7, 80)
    texts[5] = "".join(random.Random(1).choices("abcd ", k=5000))
    texts[2_000_000] = "x" + texts[5][100:4000]
    monkeypatch.setattr(sd, "CHUNK_BYTES", 700)
    monkeypatch.setattr(sd, "HASH_BYTES", 150)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert left(sd.removals(frame)) == sd.brute_force({k: v.encode() for k, v in texts.items()}, sd.SPAN)


def test_awkward_rows(spark):
    same = "one passage of more than fifty bytes, known to several documents of this test"
    rows = [(1, same, "a"), (1, same, "b"), (2, same + "!", "c"), (None, same, "d"), (3, None, "e"), (4, "", "f"), (4, "x" * 49, "g"), (5, "x" * 49, "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string").withColumnRenamed("kept", "gram")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in sd.removals(frame).collect())
    n = len(same)
    assert got == sorted([(1, n, 0), (1, n, 0), (2, n + 1, n), (0, n, 0), (3, 0, 0), (4, 0, 0), (4, 49, 0), (5, 49, 0)])
    assert sd.removals(frame.limit(0)).count() == 0


def test_sampled_positions_take_every_start_once():
    data = np.frombuffer("".join(random.Random(2).choices("ab", k=3000)).encode(), np.uint8)
    offsets = np.array([0, 30, 30, 1000, 1050, 3000])
    text, _, _, begin, count, at = sd.sampled(data, offsets, 50, 16)
    starts = sorted((t, b + i) for t, b, c in zip(text.tolist(), begin.tolist(), count.tolist(), strict=True) for i in range(c))
    assert ((at <= 50 - 16) & (at >= count - 1)).all()
    assert starts == [(t, i) for t, n in enumerate(np.diff(offsets)) for i in range(max(0, n - 49))]
