"""Quality classifier: gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm import trees
from featureflow.llm.common import judged, shared, slices, texts_of

#: Labelled documents a classifier is fitted on at most, chosen by a hash of their ids.
SAMPLE_ROWS = 30_000

_GROUPS = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": b"0123456789",
    "line": b"\n",
    "space": b" \t\r\x0b\x0c",
    "stop": b".,;:",
    "mark": b"!?",
    "quote": b"'\"()-",
    "sign": b"#$%&*@^~|<>{}[]=+_/\\`",
}
_CLASS = np.full(256, len(_GROUPS), np.uint8)  # the last class: bytes of non-ASCII characters, and control bytes
for _i, _bytes in enumerate(_GROUPS.values()):
    _CLASS[list(_bytes)] = _i


def statistics(text: str) -> list[float]:
    """Numbers that describe a text; all zero for an empty one."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    n = max(len(raw), 1)
    shares = np.bincount(_CLASS, counts, len(_GROUPS) + 1) / n
    seen = counts[counts > 0] / n
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    distinct = set(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    repeats = sum(map(eq, words, words[1:]))
    ended = sum(line.rstrip()[-1] in ".!?:\"'" for line in lines)
    capital = sum(word[0].isupper() for word in words)
    shouted = sum(word.isupper() for word in words)
    odd = sum(not word[-1].isalnum() for word in words)
    inside = sum(not word[:-1].isalpha() for word in words if len(word) > 1)
    return [
        math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)), *shares.tolist(),
        float(-(seen * np.log2(seen)).sum()), float(lengths.mean()), float(lengths.std()), math.log1p(int(lengths.max())),
        len(distinct) / n_words, len(distinct) / math.sqrt(n_words), repeats / n_words, len(set(lines)) / n_lines,
        ended / n_lines, n_words / n_lines, capital / n_words, shouted / n_words, odd / n_words, inside / n_words,
    ]


WIDTH = len(statistics(""))


def described(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(text) for text in texts.to_pylist()], np.float64).reshape(len(texts), WIDTH)


def training_sample(labels: DataFrame, label_col: str, rows: int, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label): labelled ids of `docs`, one row each, at most `rows` of them, those with the smallest hashes.

    Labels other than 0 and 1 and null ids are left out; contradictory labels of an id count as 1. Labels without a
    document take no place in the sample.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    here = docs.select("doc_id").where("doc_id is not null").distinct()
    return known.join(here, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label_col: str = "quality", **settings) -> trees.Forest:
    """Fits the forest on the labelled documents, at most `sample_rows` of them (hash sample, so the same on any cluster).

    Statistics are computed where the texts are; the driver gets a row of some 30 numbers for each sampled document.
    """
    chosen = F.broadcast(training_sample(labels, label_col, sample_rows, docs))  # at most sample_rows rows of 12 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values = described(part.column("text"))
            flat = pa.array(values.ravel())
            offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
            yield pa.record_batch([part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "label", "x"])

    rows = docs.join(chosen, "doc_id").mapInArrow(run, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    labels_np = rows["label"].to_numpy()
    values = rows["x"].combine_chunks().flatten().to_numpy() if len(labels_np) else np.zeros(0)
    return trees.fit(values.reshape(len(labels_np), WIDTH), labels_np, **settings)


def score_quality(docs: DataFrame, forest: trees.Forest) -> DataFrame:
    """doc_id, score for each row of (doc_id, text)."""
    load = shared(docs.sparkSession, forest)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = load()
        for part in slices(batches, "text"):
            scores = forest.probability(described(part.column("text")))
            yield pa.record_batch([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, **settings) -> DataFrame:
    """doc_id, score (probability of label 1), predicted (score >= 0.5), one row for each row of `docs`.

    Only the text is an input of the score. Null texts score like empty ones; null ids stay; repeated rows score
    alike; other columns are ignored. Without usable labels every score is 0.5, with one label only it is constant.
    """
    rows = texts_of(docs, id_col, text_col)
    forest = fit_quality(rows, labels, sample_rows, label_col, **settings)
    return score_quality(rows, forest).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def filtered(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, **settings) -> DataFrame:
    """The rows of `docs`, all columns, whose score is 0.5 or more, for the same classifier as `classify`."""
    forest = fit_quality(texts_of(docs, id_col, text_col), labels, sample_rows, label_col, **settings)
    load = shared(docs.sparkSession, forest)

    def judge() -> Callable[[pa.Array], np.ndarray]:
        forest = load()
        return lambda texts: forest.probability(described(texts)) >= 0.5

    return judged(docs, text_col, judge)
