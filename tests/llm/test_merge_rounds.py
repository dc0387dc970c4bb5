"""Operator 13 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece

from sluice.llm import merge_rounds
from sluice.llm.flat import Lexicon, PairTable
from sluice.llm.merge_rounds import PieceModel, piece_codec

from .frames import AWKWARD, docs, prose

MODEL = P.path("piece_bpe_32k.model")
PARTS = [
    "a", "b", "the", " ", "  ", "\n", "ab", "er", "ing", "▁", "é", "漢", "字", "😀", "\t", "\x00", "<s>", "</s>", "<0x41>",
    "aaaa", "1", "23", "ﬁ", "한국", "\u200b", "ü", "ß", "▁▁", "thethe", "\r\n",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL)


def texts(seed, n):
    r = random.Random(seed)
    out = ["", " ", "   ", "a ", " a", "a" * 300, " " * 90, "x" + " " * 57 + "y", "▁▁a", "ab" * 400, "漢字" * 50]
    out += ["".join(r.choices(PARTS, k=r.randrange(1, 40))) for _ in range(n)]
    return out + ["".join(r.choices("etaoinshrdlu", k=r.randrange(1, 70))) for _ in range(n // 4)]


def test_ids_equal_library(model, library):
    data = texts(1, 4000)
    ids, decimals, decoded = Lexicon(model.words, model.spelled, 1 << 26).coded(data, "ids", "decimals", "decoded")
    for t, i, d, plain in zip(data, ids, decimals, decoded):
        want = library.encode(t)
        assert i.tolist() == want == model.encode(t)
        assert d.tobytes().decode() == "".join(f"{w} " for w in want)
        assert plain.tobytes()[1:].decode() == library.decode(want) == model.decode(want)


def test_few_rounds_leave_the_rest_to_the_heap(model, library, monkeypatch):
    for rounds in (0, 1, 3):
        monkeypatch.setattr(merge_rounds, "MAX_ROUNDS", rounds)
        for t in texts(2, 200):
            assert model.encode(t) == library.encode(t)


def test_any_ids_decode_as_in_the_library(model, library):
    r = random.Random(3)
    some = [*range(3, 259), *range(259, 32000, 97), 0, 1, 2, 259, 29871]
    for _ in range(4000):
        ids = r.choices(some, k=r.randrange(8))
        assert model.decode(ids) == library.decode(ids)


def test_small_lexicon_forgets(model, library):
    words = Lexicon(model.words, model.spelled, 10_000)
    for seed in range(20):
        data = [prose(seed, 60), prose(seed + 100, 3)]
        assert [i.tolist() for i in words.coded(data, "ids")[0]] == [library.encode(t) for t in data]


def test_pair_table():
    r = np.random.default_rng(4)
    keys = np.unique(r.integers(0, 1 << 40, 5000))
    table = PairTable(keys, np.arange(len(keys), dtype=np.int32))
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert (table.get(np.setdiff1d(r.integers(0, 1 << 40, 5000), keys)) == -1).all()
    assert table.as_dict() == {int(k): i for i, k in enumerate(keys)}
    assert (PairTable(keys[:0], np.zeros(0, np.int32)).get(keys) == -1).all()


def test_codec_on_awkward_rows(spark, library):
    data = AWKWARD + texts(5, 60) + [prose(1, 400)] * 3
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
    got = piece_codec(docs(spark, data), MODEL, outputs=outputs)
    assert got.columns == ["doc_id", *outputs]
    want = []
    for k, t in enumerate(data):
        ident, t = t if isinstance(t, tuple) else (k, t)
        ids = library.encode(t or "", add_eos=True)
        plain = library.decode(ids)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), plain)]
        want.append((ident, len(ids), *digests, ids, plain))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_unknown_output(spark):
    assert piece_codec(docs(spark, []), MODEL).collect() == []
    with pytest.raises(ValueError, match="unknown outputs"):
        piece_codec(docs(spark, []), MODEL, outputs=("pieces",))
