"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, learned from document labels.

A sentence's score is sigmoid(bias + weights of its distinct known features); a document is toxic unless all its
sentences are not: P = 1 - prod(1 - p_s). The weights are fitted to the document labels through that product, so
sentences need no labels, and the fitted sentence scores say where a document offends.

Features are whole words and beginnings of words, so that an offending stem is known with endings no label showed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import judged, shared, slices, stored, texts_of
from featureflow.llm.quality import training_sample

#: Labelled documents the model is fitted on at most, features it may know, and documents of a full sample a feature must be in.
SAMPLE_ROWS = 10_000
VOCABULARY = 3000
LEAST_DOCS = 8
#: Beginnings of words, in letters, that are features too.
STEMS = range(5, 9)
#: Different words whose features a task remembers.
REMEMBERED = 30_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def words_of(sentence: str) -> list[str]:
    return _WORD.findall(sentence.lower())


def features_of(word: str) -> list[str]:
    """The word, and its proper beginnings of STEMS letters with a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n < len(word))]


def known_features(known: dict[str, Any]) -> Callable[[list[str]], frozenset[str]]:
    """A function from a sentence's words to its distinct features among `known`; it remembers the words it met."""
    met: dict[str, frozenset[str]] = {}

    def of(words: list[str]) -> frozenset[str]:
        own = []
        for word in set(words):
            found = met.get(word)
            if found is None:
                if len(met) >= REMEMBERED:
                    met.clear()
                found = met[word] = frozenset(f for f in features_of(word) if f in known)
            if found:
                own.append(found)
        return frozenset().union(*own)

    return of


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -40.0

    def reader(self) -> Callable[[str], list[tuple[int, int, float]]]:
        """A function from a text to (begin, end, log-odds) of its sentences with at least one word."""
        weights, bias, features = self.weights, self.bias, known_features(self.weights)

        def read(text: str) -> list[tuple[int, int, float]]:
            found = []
            for m in _SENTENCE.finditer(text):
                words = words_of(m[0])
                if words:
                    found.append((m.start(), m.end(), bias + sum(weights[f] for f in sorted(features(words)))))
            return found

        return read

    def score(self, logits: list[float]) -> float:
        """Noisy-or over the sentences; 0 without any."""
        return float(-np.expm1(-np.logaddexp(0, logits).sum())) if logits else 0.0


def floor_of(documents: int, least: int = LEAST_DOCS) -> int:
    """Documents a word must be in: `least` for a full sample, in proportion for a smaller one, but 2."""
    return min(least, max(2, -(-least * documents // SAMPLE_ROWS)))


def _told_apart(rows: DataFrame, vocabulary: int, least: int) -> list[str]:
    """The features whose presence says most about the label, by chi-square over document counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            labels = part.column("label").to_pylist()
            features = [sorted({f for word in set(words_of(text)) for f in features_of(word)}) for text in part.column("text").to_pylist()]
            repeated = np.repeat(labels, [len(f) for f in features]).astype(np.int32)
            yield pa.record_batch([pa.array([f for own in features for f in own], pa.string()), pa.array(repeated)], ["feature", "label"])

    counts = rows.mapInArrow(run, "feature string, label int").groupBy("feature").agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
    total, positive = rows.agg(F.count("*"), F.sum("label")).head()
    share = F.lit((positive or 0) / max(total, 1))
    surprise = F.abs(F.col("pos") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1e-9)
    best = counts.where(F.col("n") >= floor_of(total, least)).orderBy(F.desc(surprise), "feature").limit(vocabulary)
    return [row["feature"] for row in best.select("feature").collect()]


def _instances(rows: DataFrame, vocabulary: list[str]) -> pa.Table:
    """doc_id, label, sizes, times, words: of the different sets of known features that the document's sentences have.

    A row holds the sets' sizes, how many sentences have each, and the features' numbers, set after set. Sentences
    without a word are left out; those without a known feature share the empty set.
    """
    load = shared(rows.sparkSession, {feature: i for i, feature in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load()
        features = known_features(known)
        for part in slices(batches, "text"):
            sizes, times, words = [], [], []
            for text in part.column("text").to_pylist():
                own = Counter(tuple(sorted(known[f] for f in features(s))) for s in map(words_of, map(itemgetter(0), _SENTENCE.finditer(text))) if s)
                sizes.append([len(s) for s in own])
                times.append(list(own.values()))
                words.append([w for s in own for w in s])
            lists = [pa.array(x, pa.list_(kind)) for x, kind in ((sizes, pa.int32()), (times, pa.int64()), (words, pa.int32()))]
            yield pa.record_batch([part.column("doc_id"), part.column("label"), *lists], ["doc_id", "label", "sizes", "times", "words"])

    return rows.mapInArrow(run, "doc_id long, label int, sizes array<int>, times array<long>, words array<int>").toArrow().sort_by("doc_id")


def fit_noisy_or(labels: np.ndarray, doc: np.ndarray, times: np.ndarray, sentence: np.ndarray, word: np.ndarray, vocabulary: int, steps: int = 300, rate: float = 0.1, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the documents' log-likelihood under the noisy-or, with an L1 pull towards 0.

    doc, times: document of each sentence, and how often it is there; sentence, word: one entry for each known word of
    a sentence.
    """
    n_docs, n_sentences = len(labels), len(doc)
    weights = np.zeros(vocabulary + 1)  # the last is the bias
    weights[-1] = -7.0
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z = np.bincount(sentence, weights[word], n_sentences) + weights[-1]
        harm = np.bincount(doc, times * np.logaddexp(0, z), n_docs)
        # derivative of the log-likelihood in `harm`: -1 for label 0, 1 / (e^harm - 1) for label 1
        pull = np.where(labels > 0, 1 / np.expm1(np.clip(harm, 1e-4, 50)), -1.0)
        dz = times * pull[doc] / (1 + np.exp(-np.clip(z, -50, 50)))
        grad = np.append(np.bincount(word, dz[sentence], vocabulary), dz.sum()) / n_docs
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-5)
        weights += move
        scale = rate / (np.sqrt(square / (1 - 0.99**step)) + 1e-5)
        weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - shrink * scale[:-1], 0)
    return weights[:-1], float(weights[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY, least_docs: int = LEAST_DOCS, label_col: str = "toxic") -> Model:
    """Fits the model on at most `sample_rows` labelled documents (hash sample), stored once and read twice.

    Feature counts and sentences are made on the executors; the driver gets the vocabulary and, for each sampled
    document, the feature numbers of its different sentences. A feature must be in `floor_of` documents of the sample.
    """
    chosen = F.broadcast(training_sample(labels, label_col, sample_rows, docs))  # at most sample_rows rows of 12 bytes
    sample = stored(docs.join(chosen, "doc_id").select("doc_id", "label", "text"))
    words = _told_apart(sample, vocabulary, least_docs)
    found = _instances(sample, words)
    y = found["label"].to_numpy() if found.num_rows else np.zeros(0)
    if len(set(y.tolist())) < 2:
        return Model(bias=40.0 if len(y) and y[0] == 1 else -40.0)
    sizes = found["sizes"].combine_chunks()
    doc = np.repeat(np.arange(len(y)), np.diff(sizes.offsets.to_numpy()))
    sentence = np.repeat(np.arange(len(doc)), sizes.flatten().to_numpy())
    weights, bias = fit_noisy_or(y, doc, found["times"].combine_chunks().flatten().to_numpy(), sentence, found["words"].combine_chunks().flatten().to_numpy(), len(words))
    return Model({w: float(x) for w, x in zip(words, weights, strict=True) if x}, bias)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_offending, offending (array of begin, end, score: sentences of 0.5 or more, places in characters)."""
    load = shared(docs.sparkSession, model)  # at most `vocabulary` features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        read = model.reader()
        for part in slices(batches, "text"):
            scores, spans = [], []
            for text in part.column("text").to_pylist():
                found = read(text)
                scores.append(model.score([z for _, _, z in found]))
                spans.append([{"begin": a, "end": b, "score": float(1 / (1 + np.exp(-z)))} for a, b, z in found if z >= 0])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.record_batch([part.column("doc_id"), pa.array(scores, pa.float64()), pa.array(list(map(len, spans)), pa.int32()), pa.array(spans, kind)], ["doc_id", "score", "n_offending", "offending"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_offending int, offending array<struct<begin: long, end: long, score: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **settings) -> DataFrame:
    """doc_id, score, predicted (score >= 0.5), n_offending, offending, one row for each row of `docs`.

    Only the text is an input of the score. Null, empty and wordless texts score 0; null ids stay; repeated rows score
    alike; other columns are ignored. Without usable labels, or with label 0 only, every score is near 0.
    """
    rows = texts_of(docs, id_col, text_col)
    scored = score_toxicity(rows, fit_toxicity(rows, labels, label_col=label_col, **settings))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_offending", "offending")


def filtered(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **settings) -> DataFrame:
    """The rows of `docs`, all columns, whose score is below 0.5, for the same model as `toxicity`."""
    model = fit_toxicity(texts_of(docs, id_col, text_col), labels, label_col=label_col, **settings)
    load = shared(docs.sparkSession, model)

    def judge() -> Callable[[pa.Array], np.ndarray]:
        model = load()
        read = model.reader()
        return lambda texts: np.array([model.score([z for _, _, z in read(text)]) < 0.5 for text in texts.to_pylist()], bool)

    return judged(docs, text_col, judge)
