"""Licences in texts, by a positional index of rare words; DataFrame functions only, one pass for counts and one to scan.

Templates are licence notices as words. Document frequencies of all their words are counted over all documents. The
index has each template's rarest words (highest inverse document frequency) with their places in the template; a
template with a word in a key phrase that no document has cannot be found and is left out. Of a text's words in the
index, the rarest are looked up: a word at place i in the text and at place k in a template says that the template
begins at i - k. Beginnings on which at least two words agree are candidates; a template is found if each of its key
phrases stands, word after word, where a candidate puts it.

Key phrases that count on their own (`PHRASES`) are looked up by their rarest word at all its places, so none is missed.

Everything about a text happens in its row: nothing is shuffled but a count for each template word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import texts_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"  # that is, all but \x00-\x2F, \x3A-\x60 and \x7B-\x7F; Java reads it ten times as fast

# Phrases that name a licence, with its label.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases of the text that must be there

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def places(self) -> list[tuple[int, list[str]]]:
        """(place in the template, words) of each key phrase."""
        own, out = self.words, []
        for key in self.keys:
            words = key.split()
            out.append((next(i for i in range(len(own)) if own[i : i + len(words)] == words), words))
        return out


# Notices of common licences, as their words in lower case.
TEMPLATES = (
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4",)),
    Template("cc-by", "licensed under cc by 4 0", ("under cc by 4",)),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("terms of the gnu general public license", "free software foundation")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee", "hereby granted")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge", "associated documentation files")),
    Template("mit", "released under the mit license", ("under the mit license",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
)

#: Words of a template that the index has, and words of a text that are looked up; the rarest in either case.
INDEXED = 4
LOOKED_UP = 16


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), 1)


def _strings(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def document_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rows of `words` (array column) with each word of the vocabulary. The driver gets a row for each such word."""
    found = words.select(F.explode(F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def rarest(words: list[str], counts: dict[str, int]) -> list[str]:
    """The distinct words that are in any document, rarest first, ties by the word."""
    return sorted((w for w in set(words) if counts.get(w)), key=lambda w: (counts[w], w))


def _stands(place: Column, words: list[str]) -> Column:
    """Whether `words` stand in the text from that place on."""
    return (place >= 0) & (F.slice("words", F.greatest(place + 1, F.lit(1)), len(words)) == _strings(words))


def _agreed(votes: str) -> Column:
    """What a sorted array has more than once."""
    return F.array_distinct(F.filter(votes, lambda x, i: (i > 0) & (F.get(F.col(votes), i - 1) == x)))


def _all(arrays: list[Column], kind: str) -> Column:
    return F.concat(*arrays) if arrays else F.array().cast(kind)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, indexed: int = INDEXED, looked_up: int = LOOKED_UP) -> DataFrame:
    """doc_id, n_words, base (label, start: places of the phrases), found (label, start, share), one row for each row of `docs`.

    Words are stretches of ASCII letters, digits and non-ASCII characters of the whole text, A-Z in lower case. `base` has
    every place where a phrase's words stand consecutively, in the order of the phrases. `found` has the templates whose
    key phrases are verified, with the candidate beginning at which the greatest share of the template's words stands
    (ties: the smallest; it may be negative, if the template's beginning is missing), and that share.

    Null and empty texts have no words and find nothing; null and repeated ids stay; other columns are ignored; an empty
    table gives no rows.
    """
    read = texts_of(docs, id_col, text_col).select("doc_id", words_of(F.col("text")).alias("words"))
    everything = sorted({w for t in templates for w in t.words} | {w for _, p in phrases for w in p.split()})
    counts = document_counts(read, everything)

    postings = []  # for each template that may be found: (word, places in the template)
    for t in templates:
        possible = all(counts.get(w) for key in t.keys for w in key.split())
        postings.append([(w, [i for i, x in enumerate(t.words) if x == w]) for w in rarest(t.words, counts)[:indexed] if possible])
    anchors = [next(iter(rarest(p.split(), counts)), None) for _, p in phrases]
    index = rarest([w for own in postings for w, _ in own], counts)
    wanted = sorted({*index, *(a for a in anchors if a)})

    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: x["word"].isin(wanted))
    rows = read.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    rows = rows.withColumn("rare", F.slice(F.array_intersect(_strings(index), F.transform("hits", lambda x: x["word"])), 1, looked_up))
    rows = rows.withColumn("lookups", F.filter("hits", lambda x: F.array_contains("rare", x["word"])))

    base = []
    for (label, phrase), anchor in zip(phrases, anchors, strict=True):
        if anchor:  # else no document has any of its words
            words = phrase.split()
            before = words.index(anchor)
            places = F.filter("hits", lambda x: (x["word"] == anchor) & _stands(x["at"] - before, words))
            base.append(F.transform(places, lambda x: F.struct(F.lit(label).alias("label"), (x["at"] - before).cast("long").alias("start"))))
    begins = {}
    for number, own in enumerate(postings):
        votes = []
        for word, places in own:
            at = F.array(*map(F.lit, places))
            votes.append(F.flatten(F.transform(F.filter("lookups", lambda x: x["word"] == word), lambda x: F.transform(at, lambda k: x["at"] - k))))
        if len(own) > 1:
            begins[f"votes{number}"] = F.array_sort(F.concat(*votes))
    rows = rows.select("doc_id", "n_words", "words", _all(base, "array<struct<label:string,start:bigint>>").alias("base"), *(v.alias(name) for name, v in begins.items()))
    rows = rows.select(
        *("doc_id", "n_words", "words", "base"),
        *(_agreed(name).alias(name) for name in begins),
    )

    found = []
    for number, t in enumerate(templates):
        if f"votes{number}" in begins:
            candidates, words = F.col(f"votes{number}"), t.words
            verified = F.size(candidates) > 0
            for place, key in t.places():
                verified = verified & F.exists(candidates, lambda o: _stands(o + place, key))
            aligned = F.transform(candidates, lambda o: F.struct(F.size(F.filter(_strings(words), lambda w, k: F.get("words", o + k) == w)).alias("n"), (-o).alias("back")))
            best = F.array_max(aligned)
            entry = F.struct(F.lit(t.label).alias("label"), (-best["back"]).cast("long").alias("start"), (best["n"] / F.lit(len(words))).alias("share"))
            found.append(F.when(verified, F.array(entry)).otherwise(F.array().cast("array<struct<label:string,start:bigint,share:double>>")))
    return rows.select("doc_id", "n_words", "base", _all(found, "array<struct<label:string,start:bigint,share:double>>").alias("found"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def licence_scan(docs: DataFrame, **settings) -> DataFrame:
    """`scan`, summed up: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, base, found.

    n_base counts the phrases' places, first_word and last_word are the smallest and largest of them (else null).
    base_labels are the phrases' labels, labels also those of the templates found; distinct, sorted, joined by commas.
    score is 1 with a phrase, else the greatest share of a found template, 0 without any.
    """
    starts, own = F.transform("base", lambda x: x["start"]), F.transform("base", lambda x: x["label"])
    share = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return scan(docs, **settings).select(
        "doc_id", "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _joined(own).alias("base_labels"),
        _joined(F.concat(own, F.transform("found", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(share).alias("score"),
        "base", "found",
    )
