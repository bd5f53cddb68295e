"""Periodic runs in the words of a text, by a suffix automaton whose link tree is accessed once for each word.

A run is a stretch of words with smallest period q and at least `exponent` periods, as long as it goes. The automaton's
suffix links form a tree; the node of a prefix and its ancestors are the suffixes that end there. When a word is
appended, the path from its prefix's node to the root takes that word's place as colour. What the path had before are
segments of equal colour: the colour e is the last end of the segment's strings, the segment's deepest node their
greatest length l. If the new end r has (exponent - 1) * (r - e) <= l, the last l + r - e words have the period r - e;
e is the last occurrence, so it is the smallest period, and l is as long as possible, so the stretch begins where the
run does. The last r for which a begin and a period are found is the run's end.

The access is that of link-cut trees on a tree that is complete before the first access, so nothing is linked or cut
and the paths need no balancing: heavy paths, each with a stack of its segments, since an access always recolours the
upper end of each path it meets. An append costs O(log n) segments on average, as there.

Words that no run can contain are passed over first: within a run, each sequence of a few words stands again at a
distance of one period, which is a fraction of the stretch. That is decided for whole slices of texts by sorting.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from featureflow.llm.common import slices, texts_of

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.iinfo(np.int64).max


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def gram_of(exponent: int, least: int) -> int:
    """Words of the longest sequences that every run repeats at a distance of its period, wherever in it they begin."""
    return min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 1))


def _stretches(kept: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the stretches of consecutive `kept` places; a stretch ends before a place that begins a text."""
    cut = np.flatnonzero((np.diff(kept) != 1) | begins[kept[1:]])
    return kept[np.concatenate(([0], cut + 1))], kept[np.concatenate((cut, [len(kept) - 1]))]


def islands(codes: np.ndarray, borders: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of stretches that together contain every run of every text.

    codes: the texts' words as numbers, text after text; borders: where texts begin, and the end of the last.
    """
    gram, sizes = gram_of(exponent, least), np.diff(borders)
    none = np.zeros(0, np.int64)
    if len(codes) < gram:
        return none, none
    text = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.zeros(len(codes) + 1, bool)
    begins[borders] = True
    mixed = _mixed(codes.astype(np.uint64) + np.uint64(1))
    width = len(codes) - gram + 1
    names = mixed[:width].copy()
    for k in range(1, gram):  # equal sequences of a text have equal names; a rare clash of others only keeps more words
        names = _mixed(names * _MIX + mixed[k : k + width])
    whole = text[:width] == text[gram - 1 :]
    names = _mixed(names + text[:width].astype(np.uint64) * _MIX)
    places = np.flatnonzero(whole)
    order = places[np.argsort(names[places], kind="stable")]
    gap = np.where(names[order[1:]] == names[order[:-1]], np.diff(order), _FAR)
    near = np.full(width, _FAR)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    kept = places[near[places] <= sizes[text[places]] // exponent]
    while len(kept):
        first, last = _stretches(kept, begins)
        length = last - first + gram
        limit = np.where(length < least, 0, length // exponent)
        fits = near[kept] <= np.repeat(limit, last - first + 1)
        if fits.all():
            return first, last + gram
        kept = kept[fits]
    return none, none


def suffix_tree(words: list[int]) -> tuple[array, array, array]:
    """link, length of each state of the words' suffix automaton, and the state of each prefix.

    A state's first transition is held in two arrays; only branching states have a dictionary.
    """
    link, length, word, to, prefix = array("i", [-1]), array("i", [0]), array("q", [-1]), array("i", [0]), array("i")
    more: dict[int, dict[int, int]] = {}
    last = 0
    for size, c in enumerate(words, 1):
        state = len(length)
        link.append(0)
        length.append(size)
        word.append(-1)
        to.append(0)
        p, target = last, -1
        while p >= 0:
            if word[p] == c:
                target = to[p]
                break
            if word[p] < 0:
                word[p], to[p] = c, state
            else:
                others = more.setdefault(p, {})
                if c in others:
                    target = others[c]
                    break
                others[c] = state
            p = link[p]
        if target >= 0 and length[target] == length[p] + 1:
            link[state] = target
        elif target >= 0:
            copy = len(length)
            link.append(link[target])
            length.append(length[p] + 1)
            word.append(word[target])
            to.append(to[target])
            if target in more:
                more[copy] = dict(more[target])
            link[target] = link[state] = copy
            while p >= 0:
                if word[p] == c:
                    if to[p] != target:
                        break
                    to[p] = copy
                else:
                    others = more.get(p)
                    if others is None or others.get(c) != target:
                        break
                    others[c] = copy
                p = link[p]
        prefix.append(state)
        last = state
    return link, length, prefix


def heavy_heads(link: array, length: array) -> list[int]:
    """The uppermost state of each state's heavy path."""
    n = len(link)
    order = np.argsort(np.frombuffer(length, np.int32), kind="stable").tolist()  # parents before children
    size, heavy, best = [1] * n, [-1] * n, [0] * n
    for v in reversed(order[1:]):
        p = link[v]
        size[p] += size[v]
        if size[v] > best[p]:
            best[p], heavy[p] = size[v], v
    head = list(range(n))
    for v in order[1:]:
        if heavy[link[v]] == v:
            head[v] = head[link[v]]
    return head


def runs_of(words: list[int], exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with at least `exponent` >= 2 periods and `least` words, by start, then period."""
    link, length, prefix = suffix_tree(words)
    head = heavy_heads(link, length)
    segments: dict[int, list[tuple[int, int]]] = {}  # path: (greatest length, colour), the uppermost last
    times = exponent - 1
    found: dict[tuple[int, int], int] = {}
    for r, v in enumerate(prefix, 1):
        below = 0  # the colour just below the path at hand
        while v > 0:
            top, reach = head[v], length[v]
            stack = segments.setdefault(top, [])
            upper = stack[-1][1] if stack else 0
            while stack:
                deep, e = stack[-1]
                l = min(deep, reach)
                gap = r - e
                # a colour that goes on from the path below has its deepest state there
                if times * gap <= l and l + gap >= least and e != below:
                    found[r - l - gap, gap] = r
                if deep > reach:
                    break
                stack.pop()
                if deep == reach:
                    break
            stack.append((reach, r))
            below, v = upper, link[top]
    return sorted((start, end - start, period) for (start, period), end in found.items())


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period: by start, then period), collapsed, one row for each row of `docs`.

    Words are what ASCII white space separates, numbered from 0. A run is a stretch of words with smallest period q and
    length >= max(least, exponent * q) that no neighbouring word extends. `collapsed` joins by one space the words that
    no run contains after its first q words. Null and empty texts have no words and collapse to an empty text; null and
    repeated ids stay; other columns are ignored; an empty table gives no rows. Rows are handled on their own, nothing
    is shuffled.
    """
    if exponent < 2 or least < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = [text.split() for text in part.column("text").cast(pa.binary()).to_pylist()]
            borders = np.concatenate(([0], np.cumsum([len(words) for words in texts]))).astype(np.int64)
            everything = [word for words in texts for word in words]
            number = dict(zip(everything, range(len(everything)), strict=True))
            codes = np.fromiter(map(number.__getitem__, everything), np.int64, len(everything))
            del number, everything
            own: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            first, last = islands(codes, borders, exponent, least)
            for a, b, i in zip(first.tolist(), last.tolist(), (np.searchsorted(borders, first, "right") - 1).tolist(), strict=True):
                shift = a - int(borders[i])
                own[i].extend((start + shift, size, period) for start, size, period in runs_of(codes[a:b].tolist(), exponent, least))
            collapsed = []
            for words, runs in zip(texts, own, strict=True):
                if runs:
                    keep = np.ones(len(words), bool)
                    for start, size, period in runs:
                        keep[start + period : start + size] = False
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(words))
            sizes = np.concatenate(([0], np.cumsum([len(runs) for runs in own]))).astype(np.int32)
            flat = np.array([run for runs in own for run in runs], np.int64).reshape(-1, 3)
            listed = pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]))
            yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(borders)), listed, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)
