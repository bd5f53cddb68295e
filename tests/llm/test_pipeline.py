import importlib
import sys

import pytest

import corpus_pipeline
from featureflow.llm import quality, suffix_dedup, toxicity, tokens
from featureflow.llm.common import fold, stored
from featureflow.llm.queries import QUERIES, tokenizer_file
from test_near_dedup import brute_force

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF)))
    return out


def rows(frame) -> dict:
    return {r["doc_id"]: r for r in frame.collect()}


def test_columns_stay(stages):
    assert all(frame.columns == stages[0].columns for frame in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "suffix_dedup", "packing"]


def test_filters(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality.classify(stages[0], labels.where(fold(labels.doc_id, 3) != 1)).where("predicted = 1")
    assert set(rows(stages[1])) == {r["doc_id"] for r in good.collect()}
    clean = toxicity.toxicity(stages[1], labels.where(fold(labels.doc_id, 5) != 0)).where("predicted = 0")
    assert set(rows(stages[2])) == {r["doc_id"] for r in clean.collect()}
    before = rows(stages[0])
    assert all(before[i] == r for i, r in rows(stages[2]).items())


def test_one_of_each_group_of_near_copies_stays(stages):
    own = {i: r["text"] for i, r in rows(stages[2]).items()}
    want = brute_force(list(own.items()), 5, 80)
    assert set(rows(stages[3])) == {i for i in own if want[i][1] == i}


def test_repeated_strings_go(stages):
    before, after = rows(stages[3]), rows(stages[4])
    texts = {i: r["text"].encode() for i, r in before.items()}
    left = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.removals(stages[3]).collect()}
    import hashlib

    assert {i: hashlib.sha256(t).hexdigest() for i, t in left.items()} == suffix_dedup.brute_force(texts, 50)
    assert {i: r["text"] for i, r in after.items()} == {i: t.decode("utf-8", "ignore") for i, t in left.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_pieces_hold_every_token(stages):
    library, found = tokens.load(tokenizer_file()), {}
    for p in stages[5].collect():
        found.setdefault(p["doc_id"], []).append((p["start"], p["ids"]))
    assert {i: [x for _, ids in sorted(own) for x in ids] for i, own in found.items()} == {i: [*library.encode(r["text"], add_special_tokens=False).ids, 1] for i, r in rows(stages[4]).items()}


def test_rows_without_id_and_repeated_rows(spark):
    text = "a passage that is long enough to be compared with its copies in this test, " * 3
    docs = spark.createDataFrame([(None, text, "n"), (4, text, "a"), (4, text, "b"), (9, text, "c"), (5, None, "d"), (5, None, "e")], "doc_id long, text string, lang string")
    got = sorted(str(r["doc_id"]) for r in corpus_pipeline.near_dedup_stage(spark, docs, SF).collect())
    assert got == ["4", "5", "None"]
    one = spark.createDataFrame([(1, text, "a", 2), (2, "é" + text[:-30], "b", 2), (3, None, "c", None)], "doc_id long, text string, lang string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.suffix_dedup_stage(spark, one, SF).collect()}
    assert got[1]["text"] == text and got[2]["text"] == "é" and got[2]["n_chars"] == 1 and got[3]["text"] is None


def test_only_the_last_stage_stays_on_disk(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: str(tmp_path))
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert len(list(tmp_path.iterdir())) == 1


def test_entry_works_without_the_folder(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("featureflow.llm", "corpus_pipeline", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "featureflow.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    contract = importlib.import_module("__spark_entry__")
    assert "class_means" in contract.queries() and not [q for q in contract.queries() if q[:2] == "op" and q[2].isdigit()]
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
