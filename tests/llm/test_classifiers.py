import random
import re
from collections import Counter

import numpy as np
import pytest

from featureflow.llm import quality, toxicity, trees

NOUNS = ["river", "stone", "paper", "garden", "window", "music", "bread", "summer", "letter", "morning", "village", "forest"]
BAD = ["blockhead", "numbskull"]


def sentence(r: random.Random) -> str:
    return " ".join(r.choices(NOUNS, k=r.randint(3, 9))).capitalize() + "."


def corpus(n: int = 600) -> list[tuple]:
    """(doc_id, text, quality, toxic): junk is shouted or full of signs; toxic documents have one offending sentence or two."""
    r, rows = random.Random(5), []
    for i in range(n):
        text = [sentence(r) for _ in range(r.randint(1, 25))]
        good, toxic = r.random() < 0.8, r.random() < 0.25
        if toxic:
            for _ in range(r.randint(1, 2)):
                text.insert(r.randrange(len(text) + 1), f"You {r.choice(BAD)} of a {r.choice(NOUNS)}.")
        text = " ".join(text)
        if not good:
            text = text.upper().replace(".", "!!") if r.random() < 0.5 else text.replace(" ", "$$ #")
        rows.append((i, text, int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    rows = corpus()
    docs = [(i, t) for i, t, _, _ in rows] + [(None, "no id."), (None, None), (9000, ""), (9001, " \n"), (9002, "x" * 300_000), (3, rows[3][1])]
    labels = [(i, q, t) for i, _, q, t in rows if i % 3] + [(None, 1, 1), (9000, None, None), (9001, 7, -1)]
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as label", "1 as score").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_trees_equal_a_walk_and_learn():
    r = np.random.default_rng(1)
    x = r.normal(size=(800, 5)).round(2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(int)
    forest = trees.fit(x, y, trees=30, depth=3)
    p = forest.probability(x)
    assert ((p >= 0.5) == y).mean() > 0.98
    for row in r.integers(0, 800, 20):
        logit = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(x[row, feature[node]] > threshold[node])
            logit += leaf[node - len(feature)]
        assert np.isclose(p[row], 1 / (1 + np.exp(-logit)))
    assert np.allclose(trees.fit(x, np.ones(800)).probability(x), trees.fit(x, np.ones(800)).probability(x[:1])[0])
    assert np.allclose(trees.fit(np.zeros((0, 5)), np.zeros(0)).probability(x[:3]), 0.5)


def test_quality_on_held_out_documents(frames):
    docs, labels, rows = frames
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) + 6
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None}
    assert np.mean([by[i] == q for i, _, q, _ in rows if i % 3 == 0]) > 0.97
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_filters_keep_what_the_scores_keep(frames):
    docs, labels, _ = frames
    good = sorted(str(r["doc_id"]) for r in quality.classify(docs, labels).where("predicted = 1").collect())
    kept = quality.filtered(docs, labels)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == good and kept.columns == docs.columns
    clean = sorted(str(r["doc_id"]) for r in toxicity.toxicity(docs, labels).where("predicted = 0").collect())
    kept = toxicity.filtered(docs, labels)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == clean and kept.columns == docs.columns


def test_toxicity_on_held_out_documents(frames):
    docs, labels, rows = frames
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect() if r["doc_id"] is not None}
    held = [(got[i], text, toxic) for i, text, _, toxic in rows if i % 3 == 0]
    assert np.mean([r["predicted"] == toxic for r, _, toxic in held]) > 0.97
    for r, text, toxic in held:
        if toxic and r["predicted"]:
            found = [text[s["begin"] : s["end"]].lower() for s in r["offending"]]
            assert len(found) == r["n_offending"] > 0
            assert all(any(b in s for b in BAD) for s in found)
    assert got[9000]["score"] == got[9001]["score"] == 0


def test_labels_without_a_document_take_no_place(spark, frames):
    docs, labels, rows = frames
    strange = spark.range(100_000, 130_000).selectExpr("id as doc_id", "cast(1 as int) as quality", "cast(0 as int) as toxic")
    many = labels.unionByName(strange)
    texts = docs.select("doc_id", "text")
    chosen = {r["doc_id"] for r in quality.training_sample(many, "quality", 300, texts).collect()}
    assert len(chosen) == 300 and chosen <= {i for i, *_ in rows if i % 3}
    held = [(i, q, t) for i, _, q, t in rows if i % 3 == 0]
    good = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, many, sample_rows=300).collect()}
    assert np.mean([good[i] == q for i, q, _ in held]) > 0.97
    bad = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, many, sample_rows=300).collect()}
    assert np.mean([bad[i] == t for i, _, t in held]) > 0.95


def test_toxic_words_of_a_small_sample_are_learned(spark):
    rows = [(i, sentence(random.Random(i)) + (" You numbskull." if i % 20 == 0 else ""), int(i % 20 == 0)) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: (r["predicted"], r["n_offending"]) for r in toxicity.toxicity(docs, labels).collect()}
    assert got == {i: (t, t) for i, _, t in rows}
    assert [toxicity.floor_of(n) for n in (0, 1, 1000, 2500, 5000, 9000, 10_000)] == [2, 2, 2, 2, 4, 8, 8]


def test_repeated_sentences_reach_the_driver_once(spark):
    docs = [(1, 1, "You numbskull. A river. " * 2000), (2, 0, "A river. Paper. 12. " * 2000 + "You. Stone."), (3, 0, "")]
    found = toxicity._instances(spark.createDataFrame(docs, "doc_id long, label int, text string"), ["numbskull", "paper", "you"])
    assert found["sizes"].to_pylist() == [[2, 0], [0, 1, 1], []]
    assert found["times"].to_pylist() == [[2000, 2000], [2001, 2000, 1], []]
    assert found["words"].to_pylist() == [[0, 2], [1, 2], []]


def test_counted_sentences_fit_like_repeated_ones():
    r = np.random.default_rng(7)
    labels, doc, times = np.array([0, 1] * 10), np.arange(60) % 20, r.integers(1, 6, 60)
    word = np.where(labels[doc] > 0, r.integers(0, 3, 60), r.integers(1, 5, 60))
    once = toxicity.fit_noisy_or(labels, doc, times, np.arange(60), word, 5, steps=50)
    each = toxicity.fit_noisy_or(labels, np.repeat(doc, times), np.ones(times.sum()), np.arange(times.sum()), np.repeat(word, times), 5, steps=50)
    assert np.allclose(once[0], each[0]) and np.isclose(once[1], each[1])


def test_noisy_or():
    model = toxicity.Model({"bad": 4.0, "fine": -1.0}, -3.0)
    text = "A fine day. A bad bad day! 12 34\nBad fine"
    found = model.reader()(text)
    assert [text[a:b] for a, b, _ in found] == ["A fine day", " A bad bad day", "Bad fine"]
    assert [z for _, _, z in found] == [-4.0, 1.0, 0.0]
    p = [1 / (1 + np.exp(-z)) for _, _, z in found]
    assert np.isclose(model.score([z for _, _, z in found]), 1 - np.prod([1 - x for x in p]))


@pytest.mark.parametrize("label", [None, 0, 1])
def test_one_label_or_none(spark, label):
    docs = spark.createDataFrame([(1, "a b c."), (2, "d e f.")], "doc_id long, text string")
    labels = spark.createDataFrame([] if label is None else [(1, label, label)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, labels).collect()
    assert len({r["score"] for r in found}) == 1 and (found[0]["predicted"] == 1 or label == 0)
    found = toxicity.toxicity(docs, labels).collect()
    assert [r["predicted"] for r in found] == [int(label == 1)] * 2


def test_stems_are_known_with_new_endings(spark):
    """The toxic words share a beginning; no ending comes twice."""
    def ending(r: random.Random) -> str:
        return "".join(r.choices("aeioulmnrst", k=6))

    r, rows = random.Random(11), []
    for i in range(900):
        toxic = r.random() < 0.2
        text = [sentence(r) for _ in range(r.randint(1, 12))]
        if toxic:
            text.insert(r.randrange(len(text) + 1), f"The {r.choice(['grobbel', 'snorvek'])}{ending(r)} {r.choice(NOUNS)}.")
        elif r.random() < 0.5:
            text.append(f"The {r.choice(['plinto', 'harvest'])}{ending(r)} {r.choice(NOUNS)}.")
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i % 3], "doc_id long, toxic int")
    got = {row["doc_id"]: row for row in toxicity.toxicity(docs, labels).collect()}
    held = [(got[i]["predicted"], t) for i, _, t in rows if i % 3 == 0]
    assert sum(p for p, t in held if t) >= 0.95 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.01 * len(held)


def test_features_that_tell_apart_equal_a_plain_count(spark):
    rows = [(i, text, t) for i, text, _, t in corpus(150)]
    frame = spark.createDataFrame([(i, t, text) for i, text, t in rows], "doc_id long, label int, text string").repartition(3)
    n, pos = Counter(), Counter()
    for _, text, label in rows:
        own = set()
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            own |= {word} | {word[:k] + "*" for k in (5, 6, 7, 8) if k < len(word)}
        n.update(own)
        pos.update({f: label for f in own})
    share = sum(t for *_, t in rows) / len(rows)
    surprise = {f: abs(pos[f] - c * share) / (c * share * (1 - share) + 1e-9) ** 0.5 for f, c in n.items() if c >= 2}
    want = sorted(surprise, key=lambda f: (-surprise[f], f))
    got = toxicity._told_apart(frame, 10_000, 8)
    assert set(got) == set(want) and np.allclose([surprise[f] for f in got], [surprise[f] for f in want])
    assert toxicity._told_apart(frame, 5, 8) == got[:5]


def test_scores_equal_a_plain_noisy_or(spark):
    weights, bias = {"bad": 3.5, "stupi*": 2.0, "stupidl*": 1.0, "kind": -2.0}, -3.0
    texts = ["A bad day. So stupidly kind!", "stupid\nstupidity, bad", "", "12 34. !", "Kind words. " * 50 + "bad stupidly"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, toxicity.Model(weights, bias)).collect()}
    for i, text in enumerate(texts):
        clean = 1.0
        for part in re.split(r"[.!?\n]", text.lower()):
            words = set(re.findall("[a-z]+", part))
            if words:
                z = bias + sum(x for f, x in weights.items() if any(w == f or f[-1] == "*" and w.startswith(f[:-1]) and len(w) > len(f) - 1 for w in words))
                clean *= 1 / (1 + np.exp(z))
        assert np.isclose(got[i], 1 - clean)


def test_empty_table(spark, frames):
    docs, labels, _ = frames
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.filtered(docs.limit(0), labels).count() == 0
