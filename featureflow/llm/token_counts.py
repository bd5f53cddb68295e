"""Token counts by the whole-token shortcut.

Before any text is read, the vocabulary is searched for strings that are one word and encode alone as one token
(`prove`). Words among them count 1 without a merge; only the others go through the library's merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm import tokens
from featureflow.llm.common import slices, texts_of

_WORD_END = "</w>"


def prove(path: str) -> frozenset[str]:
    """Every vocabulary string that is a single plain word, unchanged by lower-casing, and that the library encodes as one id."""
    words = tokens.Words(path)
    byte_of = {letter: b for b, letter in enumerate(tokens.byte_letters())}
    candidates = set()
    for entry in words.library.get_vocab(with_added_tokens=False):
        if entry.endswith(_WORD_END):
            try:
                text = bytes(byte_of[c] for c in entry.removesuffix(_WORD_END)).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if text and text.lower() == text and words.split(text) == [text]:
                candidates.add(text)
    return frozenset(text for text in candidates if len(words.whole(text)) == 1)


class Counter:
    """Counts for one task's texts; remembers the number of tokens of short words that need merges."""

    def __init__(self, path: str, whole: frozenset[str]) -> None:
        self.words = tokens.Words(path)
        self.whole = whole
        self.memory: dict[str, int] = {}

    def _word(self, word: str) -> int:
        if word in self.whole:
            return 1
        n = self.memory.get(word)
        if n is None:
            n = len(self.words.merge(word))
            if len(word) <= tokens.MEMORY_CHARS:
                self.memory[word] = n
        return n

    def _piece(self, piece: str) -> int:
        if piece in self.whole:
            return 1
        words = self.words.split(piece)
        return len(self.words.whole(piece)) if words is None else sum(map(self._word, words))

    def texts(self, texts: pa.Array) -> np.ndarray:
        if len(self.memory) > tokens.MEMORY:
            self.memory.clear()
        offsets, distinct, codes = tokens.pieces_of(tokens.lowered(texts))
        counts = np.array(list(map(self._piece, distinct.to_pylist())), np.int64)
        sums = np.concatenate(([0], np.cumsum(counts[codes])))
        return sums[offsets[1:]] - sums[offsets[:-1]]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), one row for each row of `docs`.

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows are counted each; other
    columns are ignored; an empty table gives an empty result. `tokenizer_path` must exist on every machine. The
    shortcut's strings travel to the tasks: fewer than the vocabulary has entries.
    """
    shared = docs.sparkSession.sparkContext.broadcast(prove(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_path, shared.value)
        for part in slices(batches, "text", tokens.TEXT_BYTES):
            yield pa.record_batch([part.column("doc_id"), part.column("n_bytes"), pa.array(counter.texts(part.column("text")))], ["doc_id", "n_bytes", "n_tokens"])

    rows = texts_of(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
