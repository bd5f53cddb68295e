"""Token ids of whole texts by the `tokenizers` library, asked once for each distinct word.

The vocabulary's normaliser replaces white space, lower-cases and composes; its pre-tokeniser never joins text across
white space. So a text's ids are the ids of its pieces between ASCII white space, one after another, and a piece of
plain letters, numbers and signs is split here as the pattern says and its words go to the library's merges. Other
pieces (special strings, control characters, scripts beyond extended Latin) go to the library as they are. The tests
compare all this with the library applied to whole texts.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts encoded at once in a task.
TEXT_BYTES = 8 << 20
#: Words and pieces remembered in a dictionary; beyond that the memory starts anew. Longer ones are not remembered.
MEMORY = 150_000
#: Words remembered as arrays by a Python worker; beyond that the most used half stays.
REMEMBERED = 400_000
MEMORY_CHARS = 40
#: The contractions in the vocabulary's split pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Printable characters below U+0250 with one lower-case letter below U+0250: no two of them compose, none is white space.
_PLAIN_CHARS = "".join(c for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x250)]) if len(c.lower()) == 1 and ord(c.lower()) < 0x250)
_PLAIN = re.compile("[" + "".join("\\" + c if c in "[\\]^-" else c for c in _PLAIN_CHARS) + "]*")
_LETTERS = "".join(chr(c) for c in range(0x250) if chr(c).isalpha())
_NUMBERS = "".join(chr(c) for c in range(0x250) if chr(c).isnumeric())
_PLAIN_LETTERS = "".join(c for c in _LETTERS if c in _PLAIN_CHARS)
#: Where encoders stay in a Python worker.
KEPT = "featureflow_kept"
WORD = re.compile("|".join([*CONTRACTIONS, f"[{_LETTERS}]+", f"[{_NUMBERS}]", f"[^{_LETTERS}{_NUMBERS}]+"]))


def load(path: str):
    """The library's tokenizer, without threads of its own inside tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 ones for themselves, others from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(0x100 + others.index(b)) for b in range(256)]


_LETTER_OF_BYTE = byte_letters()


class Words:
    """Splits pieces into words and merges words, with the library's own model."""

    def __init__(self, path: str) -> None:
        self.library = load(path)
        self.model = self.library.model
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())

    def split(self, piece: str) -> list[str] | None:
        """The words of a piece without white space, or None where only the library can tell."""
        if piece.isascii() and piece.isalpha():
            return [piece.lower()]
        if not _PLAIN.fullmatch(piece) or ("<" in piece and any(s in piece for s in self.special)):
            return None
        return WORD.findall(piece.lower())

    def merge(self, word: str) -> list[int]:
        mapped = word if word.isascii() else "".join(_LETTER_OF_BYTE[b] for b in word.encode())
        return [token.id for token in self.model.tokenize(mapped)]

    def whole(self, piece: str) -> list[int]:
        return self.library.encode(piece, add_special_tokens=False).ids


def packed(ids: list[int]) -> bytes:
    """Unsigned 32-bit numbers in the machine's order, which numpy reads back."""
    return array("I", ids).tobytes()


def encoder(path: str) -> PieceEncoder:
    """One encoder for each vocabulary file and Python worker, kept between tasks.

    The package travels with each job, so its modules are new in every task; what stays hangs on the interpreter.
    """
    kept = vars(sys.modules.setdefault(KEPT, ModuleType(KEPT)))
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]


def lowered(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, as the normaliser makes them, unless that could make a special string: fewer distinct pieces."""
    return texts if pc.any(pc.match_substring(texts, "<|")).as_py() else pc.ascii_lower(texts)


def pieces_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(offsets of each text's pieces, distinct pieces, code of every piece)."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.dictionary, coded.indices.to_numpy()


class PieceEncoder:
    """Ids of texts; remembers the ids of short words as arrays, some 30 bytes a word."""

    def __init__(self, path: str) -> None:
        self.words = Words(path)
        self.known = pa.array([], pa.string())
        self.ids, self.lengths = np.array([], np.uint32), np.array([], np.int32)
        self.uses = np.array([], np.int32)

    def _remember(self, known: pa.Array, ids: np.ndarray, lengths: np.ndarray, uses: np.ndarray) -> None:
        """The short words; of more than REMEMBERED of them the most used half, whose uses count half from then on."""
        keep = np.flatnonzero(pc.less_equal(pc.utf8_length(known), MEMORY_CHARS).to_numpy(zero_copy_only=False))
        if len(keep) > REMEMBERED:
            keep = np.sort(keep[np.argpartition(-uses[keep], REMEMBERED // 2)[: REMEMBERED // 2]])
            uses = uses >> 1
        if len(keep) < len(known):
            known, uses = known.take(pa.array(keep)), uses[keep]
            ids, _ = joined(ids, lengths, keep, np.array([0]))
            lengths = lengths[keep]
        self.known, self.ids, self.lengths, self.uses = known, ids, lengths, uses

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct words in a row, number of each word's ids). The library merges those not remembered."""
        places = pc.index_in(words, self.known)
        new = words.filter(places.is_null())
        ids, lengths, merge = array("I"), np.zeros(len(new), np.int32), self.words.merge
        for i, word in enumerate(strings(new)):
            before = len(ids)
            ids.extend(merge(word))
            lengths[i] = len(ids) - before
        unknown = places.is_null().to_numpy(zero_copy_only=False)
        codes = places.fill_null(0).to_numpy().astype(np.int64)
        codes[unknown] = len(self.known) + np.arange(len(new))
        known = pa.concat_arrays([self.known, new])
        uses = np.concatenate((self.uses, np.zeros(len(new), np.int32)))
        uses[codes] += 1
        all_ids, all_lengths = np.concatenate((self.ids, np.frombuffer(ids, np.uint32))), np.concatenate((self.lengths, lengths))
        out, _ = joined(all_ids, all_lengths, codes, np.array([0]))
        self._remember(known, all_ids, all_lengths, uses)
        return out, all_lengths[codes]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids, place of each piece among these): plain letters first, then mixed pieces, then others."""
        alone = pc.match_substring_regex(pieces, f"^[{_PLAIN_LETTERS}]+$")
        plain = pc.match_substring_regex(pieces, f"^{_PLAIN.pattern}$")
        for special in self.words.special:
            plain = pc.and_not(plain, pc.match_substring(pieces, special))
        mixed, others = pc.and_not(plain, alone), pc.invert(pc.or_(plain, alone))
        split = pc.replace_substring_regex(pc.utf8_lower(pieces.filter(mixed)), f"({WORD.pattern})", r"\1 ")
        lists = pc.ascii_split_whitespace(split)  # each ends with an empty word, which has no ids
        coded = pa.concat_arrays([pc.utf8_lower(pieces.filter(alone)), lists.flatten()]).dictionary_encode()
        ids, lengths = self._words(coded.dictionary)
        n = len(pieces) - others.true_count
        counts = np.concatenate((np.ones(n - len(lists), np.int64), pc.list_value_length(lists).to_numpy()))
        ids, borders = joined(ids, lengths, coded.indices.to_numpy(), np.concatenate(([0], np.cumsum(counts))))
        whole = [self.words.whole(piece) for piece in strings(pieces.filter(others))]
        ids = np.concatenate((ids, np.array([i for x in whole for i in x], np.uint32)))
        lengths = np.concatenate((np.diff(borders), np.array([len(x) for x in whole], np.int64)))
        places = np.empty(len(pieces), np.int64)
        for mask, first in ((alone, 0), (mixed, n - len(lists)), (others, n)):
            places[mask.to_numpy(zero_copy_only=False)] = first + np.arange(mask.true_count)
        return ids, lengths, places

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row as uint32, offsets of the texts in them); `end_id` follows each text."""
        offsets, distinct, codes = pieces_of(lowered(texts))
        ids, lengths, places = self._pieces(distinct)
        codes = places.astype(np.int32)[codes]
        if end_id is not None:  # the end is one more piece after each text's last
            ids, lengths = np.append(ids, np.uint32(end_id)), np.append(lengths, 1)
            codes = np.insert(codes, offsets[1:], len(lengths) - 1)
            offsets = offsets + np.arange(len(offsets))
        return joined(ids, lengths, codes, offsets)


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def gathered(ids: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `joined`, for the packed ids of each piece."""
    return joined(np.frombuffer(b"".join(ids), np.uint32), np.array([len(x) >> 2 for x in ids], np.int32), codes, offsets)


def joined(flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the coded pieces one after another, and the places where the texts begin; offsets count pieces.

    `flat` holds the ids of each piece in a row, `lengths` how many each has.
    """
    lengths = lengths.astype(np.int32, copy=False)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    taken = lengths[codes]
    ends = np.cumsum(taken, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
    where = np.repeat((starts[codes] - (ends - taken)).astype(kind), taken)
    where += np.arange(total, dtype=kind)
    return flat[where], np.concatenate(([0], ends))[offsets]
