import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from featureflow.llm import sentence_pieces as sp
from featureflow.llm.queries import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
AWKWARD = [
    "", " ", "  ", "a", " a", "a b", "a  b ", "a\nb\tc", "\n", "\n\n x\n", "日本 ﬁ é é ½ Å 😀", "<s>x</s> <unk> <0x41>", "a b　c", "\x00a", "    deep\n        code;\r\n", "=" * 40,
    "x" * 300, "internationalisation's unbelievably", "ααβ Привет мир", "aaaaaaa aaa aaaa", "ththththth ererer", "​﻿z", "٣٤ ۵", "!?!?...", "http://example.org/a_b?c=1&d=2",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return sp.load_pieces(PATH)


def unigram_model(folder, seed: int) -> str:
    """A Unigram model of the same pieces. Scores are eighths, so that sums are exact in any order and ties are many."""
    spec = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        spec.ParseFromString(file.read())
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    r = random.Random(seed)
    for piece in spec.pieces:
        if piece.type == piece.NORMAL:
            piece.score = -r.randint(8, 80) / 8 * (1 if seed else len(piece.piece) ** 0.5 // 1)
    path = folder / f"unigram{seed}.model"
    path.write_bytes(spec.SerializeToString())
    return str(path)


@pytest.mark.parametrize("seed", range(3))
def test_unigram_models(tmp_path, seed):
    path = unigram_model(tmp_path, seed)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = sp.Encoder(path, sp.load_pieces(path))
    for i in range(8):
        texts = random_texts(i) + AWKWARD
        ids, offsets = encoder.encode(pa.array(texts))
        for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == model.encode(text), text


def test_unigram_paths_by_brute_force(tmp_path):
    """The sum of scores is the best of all ways to cut the word."""
    path = unigram_model(tmp_path, 1)
    pieces = sp.load_pieces(path)
    viterbi, score = sp.Viterbi(pieces), dict(zip(pieces.names, pieces.scores.tolist(), strict=False))
    words = ["▁" + "".join(random.Random(i).choices("theranisß", k=8)) for i in range(60)]

    def best(word: str) -> float:
        if not word:
            return 0.0
        own = [score[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in score]
        return max(own if word[0] in score else [*own, float(pieces.scores[-1]) + best(word[1:])])

    found, counts, sizes = viterbi.equal_length(words)
    assert sizes.sum() == sum(map(len, words))
    sums = [float(x.sum()) for x in np.split(pieces.scores[found], np.cumsum(counts)[:-1])]
    assert sums == [best(word) for word in words]


def test_unigram_documents(spark, tmp_path):
    path = unigram_model(tmp_path, 0)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in sp.decode(sp.encode(docs, path), path).collect():
        assert r["ids"] == model.encode(r["text"])
        assert r["decoded"] == r["text"]


def test_models_of_other_kinds_are_refused(tmp_path):
    for change in ({"model_type": 3}, {"treat_whitespace_as_suffix": True}):
        spec = sentencepiece_model_pb2.ModelProto()
        with open(unigram_model(tmp_path, 1), "rb") as file:
            spec.ParseFromString(file.read())
        for name, value in change.items():
            setattr(spec.trainer_spec, name, value)
        path = tmp_path / "other.model"
        path.write_bytes(spec.SerializeToString())
        with pytest.raises((ValueError, RuntimeError)):
            sp.load_pieces(str(path))


def random_texts(seed: int) -> list[str]:
    r = random.Random(seed)
    letters = r.choice(["ab ", "theranisoutd  \n", "aeiouéüß stnr.,", "01 =-_()<>\t\r\n", "日本中国 の漢字😀ü"])
    return ["".join(r.choices(letters, k=r.randint(0, 120))) for _ in range(150)]


def test_equals_the_library(library, pieces):
    encoder = sp.Encoder(PATH, pieces)
    for seed in range(8):
        texts = random_texts(seed) + AWKWARD
        ids, offsets = encoder.encode(pa.array(texts))
        for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == library.encode(text), text


def test_equals_the_library_on_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sp.decode(sp.encode(docs, PATH), PATH).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["ids"] == library.encode(r["text"])
        assert r["decoded"] == r["text"]


def test_rows(spark, library):
    rows = [(1, "a b", "x"), (None, None, "y"), (1, "a b", "z"), (2, "", None), *((i + 10, t, "t") for i, t in enumerate(AWKWARD))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoder string").repartition(3)
    got = sp.decode(sp.encode(docs, PATH), PATH)
    assert got.columns == ["doc_id", "text", "decoder", "ids", "decoded"]
    key = lambda r: (r[0] or 0, r[1] or "", r[2] or "")
    for r, (i, text, _) in zip(sorted(got.collect(), key=key), sorted(rows, key=key), strict=True):
        assert (r["doc_id"], r["text"]) == (i, text)
        assert r["ids"] == library.encode(text or "")
        assert r["decoded"] == (text or "").replace("▁", " ") == library.decode(r["ids"])
    assert got.limit(0).count() == 0
    trips = sorted(sp.round_trips(docs, PATH).collect(), key=lambda r: r["doc_id"] or 0)
    for r, (i, text, _) in zip(trips, sorted(rows, key=lambda r: r[0] or 0), strict=True):
        ids = library.encode(text or "")
        assert (r["doc_id"], r["n_tokens"], r["ids_crc32"]) == (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r["round_trip"]
    with pytest.raises(ValueError, match="already"):
        sp.encode(docs, PATH, ids_col="decoder")


def test_decoding_like_the_library(spark, library):
    ids = [[], [1, 264, 2], [0, 264], [3 + 0xC3, 3 + 0xA9], [3 + 0xFF, 264], [28705, 28705, 264], None]
    got = sp.decode(spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, ids array<int>").coalesce(1), PATH).collect()
    for r in got:
        if r["ids"] is None:
            assert r["decoded"] is None
        elif 0 not in r["ids"]:
            assert r["decoded"] == library.decode(r["ids"])
