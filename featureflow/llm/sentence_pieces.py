"""SentencePiece encoding and decoding by a batched numpy Viterbi pass, for Unigram and BPE models.

Distinct words of equal length advance together, one character a step. At each position every possible last piece is
probed: the substring's hash in the sorted hashes of the pieces. The best one is stored with the way back.

* Unigram models: the best is the maximum of the sum of scores up to the candidate's start and its own score, over all
  words and sizes at once; of equal sums the longest piece stays, as in the library.
* BPE models: scores decide the merges' order, and what merging leaves is not the path with the best sum. So a
  candidate is allowed if it is what merging would leave after the last piece at its start; exactly one is, and the
  longest is asked first. Whether piece b may follow piece a ("merging a b's text leaves a, b") is found by undoing the
  merges of both, the latest first, and asking at each state whether a pair across the border would have been merged
  earlier.

The result is the library's. It sums in single precision from the text's beginning, here from the word's: Unigram
paths whose sums differ by that rounding alone may be exchanged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from featureflow.llm import tokens
from featureflow.llm.common import shared, slices, texts_of
from featureflow.llm.near_dedup import mixed
from featureflow.llm.suffix_dedup import _INVERSE, _POWER

SPACE = "▁"
#: Longer words, and words after several spaces, go to the library one by one.
WORD_CHARS = 48
#: What an unknown character scores below the least piece of a Unigram model.
UNKNOWN = 10.0
_NEVER = np.int64(1 << 40)
_BEGIN_BITS = 20


@dataclass(frozen=True)
class Pieces:
    """A model's pieces; for BPE in merge order (single characters first), `left` and `right` the parts of the last merge.

    `scores` (single precision; the last is an unknown character's) are those of a Unigram model, else none.
    """

    names: tuple[str, ...]
    ids: np.ndarray
    scores: np.ndarray
    left: np.ndarray
    right: np.ndarray
    bytes_from: int
    text_of_id: tuple[bytes, ...]


def last_merge(text: str, score: dict[str, float]) -> tuple[str, str] | None:
    """The two parts that merging a text joins last, if it ends as one piece."""
    parts = list(text)
    while len(parts) > 1:
        options = [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in score]
        if not options:
            return None
        i = min(options)[1]
        pair = parts[i], parts[i + 1]
        parts[i : i + 2] = ["".join(pair)]
    return pair


def load_pieces(path: str) -> Pieces:
    """The tables of a model file: a few numbers for each piece.

    Models must be of the two kinds, leave texts as they are but for a space in front, and spell unknown characters in bytes.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    kind, normal = spec.trainer_spec.model_type, spec.normalizer_spec
    if kind not in (spec.trainer_spec.UNIGRAM, spec.trainer_spec.BPE) or any(p.type == p.USER_DEFINED for p in spec.pieces):
        raise ValueError("the model must be a Unigram or BPE model without user-defined pieces")
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.add_dummy_prefix or not normal.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model must leave texts as they are, with one space in front")
    score, ids, text_of_id, first_byte = {}, {}, [], None
    for i in range(model.vocab_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            first_byte = i if first_byte is None else first_byte
            text_of_id.append(bytes([int(name[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            text_of_id.append(b"")
        else:
            score[name], ids[name] = model.get_score(i), i
            text_of_id.append(name.replace(SPACE, " ").encode())
    if first_byte is None or any(SPACE in name.lstrip(SPACE) for name in score):
        raise ValueError("the model must have byte pieces, and no piece that goes on beyond a space")
    if kind == spec.trainer_spec.UNIGRAM:
        names, own = list(score), np.arange(len(score))
        scores = np.array([*score.values(), min(score.values()) - np.float32(UNKNOWN)], np.float32)
        return Pieces(tuple(names), np.array(list(ids.values())), scores, own, own, first_byte, tuple(text_of_id))
    made = {name: last_merge(name, score) for name in score if len(name) > 1 and SPACE * 2 not in name}
    names = [n for n in score if len(n) == 1] + sorted((n for n, parts in made.items() if parts), key=lambda n: -score[n])
    place = {n: i for i, n in enumerate(names)}
    parts = [made.get(n) or (n, n) for n in names]
    return Pieces(tuple(names), np.array([ids[n] for n in names]), np.zeros(0, np.float32), np.array([place[a] for a, _ in parts]), np.array([place[b] for _, b in parts]), first_byte, tuple(text_of_id))


def _characters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length).astype(np.uint64)


class Viterbi:
    """Encodes words with one leading space mark; remembers pairs of pieces that were tried."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.size = len(pieces.names)
        self.longest = max(map(len, pieces.names))
        n = 2 * self.longest + WORD_CHARS + 2
        self.powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _POWER))))
        self.inverses = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _INVERSE))))
        self.lengths = np.array([len(name) for name in pieces.names])
        self.raw = np.array([self._sums(_characters([name], len(name)))[0, -1] for name in pieces.names], np.uint64)
        hashes = mixed(self.raw)
        self.order = np.argsort(hashes)
        self.keys = hashes[self.order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same hash")
        self.begins = np.zeros(1 << _BEGIN_BITS, bool)  # most substrings are no piece: told by their hash's first bits
        self.begins[self.keys >> np.uint64(64 - _BEGIN_BITS)] = True
        self.tried = np.zeros(0, np.int64)
        self.allowed = np.zeros(0, bool)

    def _sums(self, characters: np.ndarray) -> np.ndarray:
        """Prefix sums of each row, from which the name of any substring follows."""
        n, length = characters.shape
        sums = np.zeros((n, length + 1), np.uint64)
        np.cumsum(mixed(characters + np.uint64(1)) * self.powers[:length], 1, out=sums[:, 1:])
        return sums

    def _probe(self, raw: np.ndarray) -> np.ndarray:
        """The piece with that raw hash, or _NEVER."""
        hashes = mixed(raw)
        out = np.full(len(hashes), _NEVER)
        likely = np.flatnonzero(self.begins[hashes >> np.uint64(64 - _BEGIN_BITS)])
        hashes = hashes[likely]
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = self.keys[at] == hashes
        out[likely[hit]] = self.order[at[hit]]
        return out

    def _follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of pieces a, b leaves a, b."""
        left, right = self.pieces.left, self.pieces.right
        a, b, good = a.copy(), b.copy(), np.ones(len(a), bool)
        limit, live = np.full(len(a), _NEVER), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            joined = self._probe(self.raw[x] + self.raw[y] * self.powers[self.lengths[x]])
            good[live[joined < limit[live]]] = False
            live = live[joined >= limit[live]]
            x, y = a[live], b[live]
            whole_x, whole_y = left[x] == x, left[y] == y  # single characters were never merged
            undo_x = np.where(x > y, ~whole_x, whole_y & ~whole_x)
            undo_y = ~undo_x & ~whole_y
            limit[live] = np.where(undo_x, x, y + 1)
            a[live[undo_x]] = right[x[undo_x]]
            b[live[undo_y]] = left[y[undo_y]]
            live = live[undo_x | undo_y]
        return good

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs, where = np.unique(a * (self.size + 1) + b, return_inverse=True)
        at = np.searchsorted(self.tried, pairs)
        known = (at < len(self.tried)) & (self.tried[np.minimum(at, len(self.tried) - 1)] == pairs) if len(self.tried) else np.zeros(len(pairs), bool)
        new = pairs[~known]
        if len(new):
            x, y = np.divmod(new, self.size + 1)
            plain = (x < self.size) & (y < self.size)  # unknown characters never merge
            answer = np.ones(len(new), bool)
            answer[plain] = self._follows(x[plain], y[plain])
            place = at[~known]
            self.tried, self.allowed = np.insert(self.tried, place, new), np.insert(self.allowed, place, answer)
        return self.allowed[np.searchsorted(self.tried, pairs)][where]

    def _possible(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may follow the best one before it, or begins the word."""
        good = before < 0
        good[~good] = self.follows(before[~good], piece[~good])
        return good

    def _merged(self, last: np.ndarray, end: int, row: np.ndarray, piece: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each word the candidate that merging leaves; sizes ascend."""
        longest = np.zeros(last.shape[1], np.int64)
        longest[row] = np.arange(len(row))  # the last one stays
        near = self._possible(last[end - size[longest], np.arange(len(longest))], piece[longest])
        rest = np.flatnonzero(~near[row])
        rest = rest[self._possible(last[end - size[rest], row[rest]], piece[rest])]
        longest[row[rest]] = rest  # just one is possible for each word
        return longest

    def equal_length(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pieces of all words, their number in each word, their sizes) for words of as many characters.

        An unknown character is the number of pieces.
        """
        n, length = len(words), len(words[0])
        sums = self._sums(_characters(words, length))
        last, back = np.full((length + 1, n), -1, np.int64), np.zeros((length + 1, n), np.int64)
        rows = np.arange(n)
        total = np.zeros((length + 1, n), np.float32)
        for end in range(1, length + 1):
            found = []
            for size in range(1, min(end, self.longest) + 1):
                piece = self._probe((sums[:, end] - sums[:, end - size]) * self.inverses[end - size])
                if size == 1:
                    piece = np.minimum(piece, self.size)
                hit = np.flatnonzero(piece <= self.size)
                found.append((hit, piece[hit], np.full(len(hit), size)))
            row, piece, size = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(self.pieces.scores):
                sums_here = total[end - size, row] + self.pieces.scores[piece]
                total[end] = -np.inf
                np.maximum.at(total[end], row, sums_here)
                near = np.flatnonzero(sums_here == total[end, row])
                best = np.zeros(n, np.int64)
                best[row[near]] = near  # sizes ascend, so the longest of equal sums stays
            else:
                best = self._merged(last, end, row, piece, size)
            last[end], back[end] = piece[best], size[best]
        ends, steps = np.full(n, length), []
        while ends.any():
            steps.append((np.where(ends > 0, last[ends, rows], -1), back[ends, rows]))
            ends = ends - steps[-1][1]
        pieces, sizes = (np.stack(x[::-1], 1) for x in zip(*steps, strict=True))
        used = pieces >= 0
        return pieces[used], used.sum(1), sizes[used]


class Encoder:
    """Ids of texts; remembers the ids of short words."""

    def __init__(self, path: str, pieces: Pieces) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = pieces
        self.viterbi = Viterbi(pieces)
        self.memory: dict[str, bytes] = {}
        self.runs = re.compile("(▁+)([^▁]*)")
        #: A line break that no piece contains stands alone, so words end there.
        self.pattern = re.compile("▁+[^▁]*" if any("\n" in n for n in pieces.names) else "▁+[^▁\n]*|\n|[^▁\n]+")

    def _alone(self, word: str) -> list[int]:
        """By the library. It puts a space mark in front, so a word without one gets a line break there, cut off again."""
        if word[0] == SPACE:
            return self.model.encode(word[1:])
        return self.model.encode("\n" + word)[2:]

    def _encode_new(self, words: list[str]) -> dict[str, bytes]:
        found, by_length = {}, {}
        for word in words:
            if len(word) > WORD_CHARS or word[:2] == SPACE * 2:
                found[word] = tokens.packed(self._alone(word))
            else:
                by_length.setdefault(len(word), []).append(word)
        unknown = self.viterbi.size
        ids = np.append(self.pieces.ids, 0).astype(np.uint32)
        for group in by_length.values():
            pieces, counts, sizes = self.viterbi.equal_length(group)
            raw, ends = ids[pieces].tobytes(), np.cumsum(counts)
            borders = [0, *(4 * ends).tolist()]
            found.update((word, raw[x:y]) for word, x, y in zip(group, borders, borders[1:], strict=False))
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(pieces == unknown), "right")).tolist():
                own = slice(int(ends[i] - counts[i]), int(ends[i]))
                found[group[i]] = tokens.packed(self._with_bytes(group[i], pieces[own].tolist(), sizes[own].tolist()))
        return found

    def _with_bytes(self, word: str, pieces: list[int], sizes: list[int]) -> list[int]:
        """Ids of a word with unknown characters, which become their bytes."""
        out, at = [], 0
        for piece, size in zip(pieces, sizes, strict=True):
            known = piece < self.viterbi.size
            out += [int(self.pieces.ids[piece])] if known else [self.pieces.bytes_from + b for b in word[at : at + size].encode()]
            at += size
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row as uint32, offsets of the texts in them)."""
        if len(self.memory) > tokens.MEMORY:
            self.memory.clear()
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        offsets, codes = lists.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy()
        offsets = offsets - offsets[0]
        pieces = [SPACE + piece for piece in coded.dictionary.to_pylist()]
        # a piece is a space and what follows it, unless that is another space or its mark: those texts are split whole
        odd = np.array([len(p) == 1 or SPACE in p[1:] for p in pieces], bool)
        runs = np.add.reduceat(np.append(odd[codes], False), offsets[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        counts, parts, begin = np.diff(offsets), [], 0
        for row in np.flatnonzero(runs).tolist():
            text = texts[row].as_py()
            own = [s + w for s, w in self.runs.findall(SPACE + text.replace(" ", SPACE))] if text else []
            parts += [codes[offsets[begin] : offsets[row]], np.arange(len(pieces), len(pieces) + len(own))]
            counts[row], begin = len(own), row + 1
            pieces += own
        parts.append(codes[offsets[begin] :])
        return tokens.gathered(self._pieces(pieces), np.concatenate(parts), np.concatenate(([0], np.cumsum(counts))))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with a space mark; they are split at line breaks into words."""
        get = self.memory.get
        out = [get(piece) for piece in pieces]
        missing = [i for i, ids in enumerate(out) if ids is None]
        words = [self.pattern.findall(pieces[i]) for i in missing]
        new = self._encode_new(list({w for own in words for w in own if w not in self.memory}))
        for i, own in zip(missing, words, strict=True):
            out[i] = ids = b"".join([get(w) or new[w] for w in own])
            if len(pieces[i]) <= tokens.MEMORY_CHARS:
                self.memory[pieces[i]] = ids
        return out


class Decoder:
    """Texts of ids; the space mark that encoding puts in front goes."""

    def __init__(self, text_of_id: tuple[bytes, ...]) -> None:
        self.lengths = np.array(list(map(len, text_of_id)))
        self.block = np.frombuffer(b"".join(text_of_id), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        where = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        where += np.arange(len(where))
        raw, borders = self.block[where].tobytes(), np.concatenate(([0], ends))[offsets].tolist()
        return [raw[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(borders, borders[1:], strict=False)]


def _cached(path: str, pieces: Pieces, encoders: dict[str, Encoder] = {}) -> Encoder:  # noqa: B006
    """One encoder for each model and Python worker."""
    if path not in encoders:
        encoders[path] = Encoder(path, pieces)
    return encoders[path]


def _with(frame: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*frame.schema.fields, StructField(name, kind)])


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows of `docs` with `ids_col`, the ids of the whole text; null and empty texts have none.

    Equal to the library's encoding without begin and end marks. `ids_col` must be a new name. The model file must
    exist on every machine.
    """
    if ids_col in docs.columns:
        raise ValueError(f"there is a column {ids_col} already")
    load = shared(docs.sparkSession, load_pieces(model_path))  # a few numbers for each piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _cached(model_path, load())
        for part in slices(batches, text_col, tokens.TEXT_BYTES):
            ids, offsets = encoder.encode(part.column(text_col).fill_null(""))
            yield part.append_column(ids_col, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32))))

    return docs.mapInArrow(run, _with(docs, ids_col, ArrayType(IntegerType())))


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`rows` with `text_col`, the text of the ids: null for null ids, and what is no UTF-8 replaced, as the library does.

    Ids outside the vocabulary are an error.
    """
    load = shared(rows.sparkSession, load_pieces(model_path).text_of_id)  # the vocabulary's texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(load())
        for part in batches:
            lists = part.column(ids_col)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            texts = decoder.decode(lists.flatten().to_numpy(), offsets - offsets[0])
            kept = [t if valid else None for t, valid in zip(texts, lists.is_valid().to_pylist(), strict=True)]
            yield part.append_column(text_col, pa.array(kept, pa.string()))

    return rows.mapInArrow(run, _with(rows, text_col, StringType()))


def round_trips(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (unsigned, over little-endian unsigned 32-bit ids), round_trip, for each row.

    Encodes every whole text and decodes the ids again; `round_trip` tells whether that gave the text. Null texts count
    as empty: no tokens, and true. Both ways run in one Python worker for each task.
    """
    load = shared(docs.sparkSession, load_pieces(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load()
        encoder, decoder = _cached(model_path, pieces), Decoder(pieces.text_of_id)
        for part in slices(batches, "text", tokens.TEXT_BYTES):
            ids, offsets = encoder.encode(part.column("text"))
            same = [a == b for a, b in zip(decoder.decode(ids, offsets), part.column("text").to_pylist(), strict=True)]
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(sums, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids_crc32", "round_trip"])
        encoder.memory.clear()  # the worker stays for other tasks

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
