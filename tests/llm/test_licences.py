import random
import re

from featureflow.llm import licences
from featureflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words_of(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", lower)


def plain_base(text: str | None) -> list[tuple[str, int]]:
    words, out = words_of(text), []
    for label, phrase in licences.PHRASES:
        own = phrase.split()
        out += [(label, i) for i in range(len(words)) if words[i : i + len(own)] == own]
    return out


def plain_found(texts: list[str | None]) -> list[list[tuple[str, int, float]]]:
    """The method, text by text: places of rare words vote for beginnings, key phrases are verified."""
    all_words = [words_of(t) for t in texts]
    counts = {w: n for w in {w for t in licences.TEMPLATES for w in t.words} if (n := sum(w in set(own) for own in all_words))}
    possible = [all(w in counts for key in t.keys for w in key.split()) for t in licences.TEMPLATES]
    rare = [sorted(set(t.words) & counts.keys(), key=lambda w: (counts[w], w))[: licences.INDEXED] if ok else [] for t, ok in zip(licences.TEMPLATES, possible, strict=True)]
    index = {w for own in rare for w in own}
    out = []
    for words in all_words:
        looked_up = set(sorted(index & set(words), key=lambda w: (counts[w], w))[: licences.LOOKED_UP])
        found = []
        for t, own in zip(licences.TEMPLATES, rare, strict=True):
            votes = {}
            for i, w in enumerate(words):
                for k, x in enumerate(t.words):
                    if w == x and w in own and w in looked_up:
                        votes[i - k] = votes.get(i - k, 0) + 1
            begins = [o for o, n in votes.items() if n > 1]
            if len(own) > 1 and begins and all(any(o + k >= 0 and words[o + k : o + k + len(key)] == key for o in begins) for k, key in t.places()):
                share = {o: sum(0 <= o + k < len(words) and words[o + k] == w for k, w in enumerate(t.words)) / len(t.words) for o in begins}
                best = min(begins, key=lambda o: (-share[o], o))
                found.append((t.label, best, share[best]))
        out.append(found)
    return out


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choices(["the", "a", "river", "of", "this", "work", "is", "to", "stone", "license", "file", "été"], k=n))


def texts() -> list[str | None]:
    r, out = random.Random(4), []
    for _ in range(150):
        parts = [prose(r, r.randint(0, 60))]
        for _ in range(r.choice([0, 0, 1, 1, 3])):
            t = r.choice(licences.TEMPLATES).text.upper() if r.random() < 0.7 else r.choice(licences.PHRASES)[1]
            if r.random() < 0.3:
                t = " ".join(t.split()[r.randint(1, 2) :])
            parts += [t.replace(" ", r.choice([" ", ", ", "-\n"])), prose(r, r.randint(0, 30))]
        out.append(". ".join(parts))
    phrase = "Under the MIT License! "
    return [*out, None, "", " \n!?", phrase * 3, "under the mit", "mit license", "İ under the mit license", "under_the-mit\x7flicense", "apache license version 2" + " word" * 200_000 + " cc by-nc"]


def test_scan_equals_a_plain_one(spark):
    own = texts()
    docs = spark.createDataFrame(list(enumerate(own)) + [(None, own[0]), (3, own[3])], "doc_id long, text string").selectExpr("*", "1 as words", "'x' as hits", "2 as n").repartition(4)
    rows = licences.scan(docs).collect()
    assert len(rows) == len(own) + 2
    by = {r["doc_id"]: r for r in rows}
    want = plain_found([*own, own[0], own[3]])
    assert any(want) and len({label for found in want for label, *_ in found}) > 8
    for i, text in enumerate(own):
        assert by[i]["n_words"] == len(words_of(text))
        assert [tuple(x) for x in by[i]["base"]] == plain_base(text)
        assert [tuple(x) for x in by[i]["found"]] == want[i]
    assert licences.scan(docs.limit(0)).count() == 0


def test_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = plain_found([d["text"] for d in docs])
    got = {r["doc_id"]: r for r in QUERIES["op12_license_scan"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc, own in zip(docs, found, strict=True):
        base, row = plain_base(doc["text"]), got[doc["doc_id"]]
        assert (row["n_words"], row["n_base"]) == (len(words_of(doc["text"])), len(base))
        assert (row["first_word"], row["last_word"]) == ((min(i for _, i in base), max(i for _, i in base)) if base else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for label, _ in base}))
        assert row["labels"] == ",".join(sorted({label for label, _ in base} | {label for label, *_ in own}))
        assert row["score"] == (1.0 if base else max((share for *_, share in own), default=0.0))


def test_other_phrases_and_templates(spark):
    docs = spark.createDataFrame([(1, "Free as in beer, free as in speech"), (2, "free beer")], "doc_id long, text string")
    one = licences.Template("beer", "free as in beer", ("in beer",))
    got = {r["doc_id"]: r for r in licences.licence_scan(docs, templates=(one,), phrases=(("free", "free as in"),)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["labels"]) == (2, 0, 4, "beer,free")
    assert (got[2]["n_base"], got[2]["labels"], got[2]["score"]) == (0, "", 0.0)
    assert {r["n_base"] for r in licences.licence_scan(docs, templates=(), phrases=()).collect()} == {0}
