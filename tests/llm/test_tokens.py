"""Operators 5 and 9 against the tokenizer libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from sluice.llm.prefix_bpe import PrefixTable, Vocabulary, bpe_codec, lexicon, merge_bytes, split_segments, vocabulary
from sluice.llm.token_counts import ChunkEncoder, token_counts

from .frames import AWKWARD, docs, prose

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = P.path("word_bpe_49k.json")
PIECES = [
    "a", "B", "é", "é", " ", "  ", "\n", "word", "Σ", "'s", "9", "\x1c", "\xa0", "　", "ß", "ﬁ", "x" * 30, " the",
    "ation", "\r\n", "\t", "日本", "123", "'", "!!", " .", "<|endoftext|>", "<|start", "oftext|>", "ÉT", "Und,",
]


def random_text(r, most=40):
    return "".join(r.choice(PIECES) for _ in range(r.randrange(most)))


@pytest.fixture(scope="module")
def vocab():
    return vocabulary(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def test_encoding_equals_library(vocab, library):
    r = random.Random(5)
    texts = [random_text(r) for _ in range(1500)] + ["x" * 200, "ab" * 150, "é" * 300, " " * 400 + "a", "don't  we'll"]
    texts += ["".join(r.choices("etaoinshrdlué", k=r.randrange(1, 150))) for _ in range(1000)]
    ids, decimals, decoded = lexicon(RANKS, P.PATTERN).coded(texts, "ids", "decimals", "decoded")
    for text, i, d, plain in zip(texts, ids, decimals, decoded):
        want = library.encode_ordinary(text)
        assert i.tolist() == want
        assert d.tobytes().decode() == "".join(f"{w}," for w in want)
        assert plain.tobytes() == text.encode() == vocab.decode(want)
    assert all(vocab.encode(t) == library.encode_ordinary(t) for t in texts[:60])


def test_other_patterns_are_not_cut(vocab):
    """A pattern whose matches reach across blanks."""
    pattern = r"\p{L}+ \p{L}+|\s+|\S+"
    own = Vocabulary(vocab.ranks, pattern)
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=vocab.ranks, special_tokens={})
    text = "the theory of the other day. a  b"
    assert own.segments(text) == [text] and vocab.segments(text) != [text]
    assert own.encode(text) == other.encode_ordinary(text)


def test_what_is_remembered_is_bounded_by_bytes(vocab, library):
    small = lexicon(RANKS, P.PATTERN, 200_000)
    r = random.Random(12)
    for _ in range(8):  # indented lines: blanks beside other white space
        texts = ["\n    ".join(random_text(r, 5) for _ in range(60)) for _ in range(6)]
        assert [i.tolist() for i in small.coded(texts, "ids")[0]] == [library.encode_ordinary(t) for t in texts]
        assert small.used() < 1_500_000
    assert len(split_segments("if a:\n    b = c d\n    e f")) == 6


def test_segments_rejoin():
    r = random.Random(6)
    for _ in range(500):
        text = random_text(r)
        assert "".join(split_segments(text)) == text


def test_prefixes_appends_and_edits(vocab):
    r = random.Random(7)
    for _ in range(150):
        data = bytes(r.choice(b"abet hinson") for _ in range(r.randrange(1, 120)))
        table = PrefixTable(vocab, data[: len(data) // 2])
        table.append(data[len(data) // 2 :])
        for size in range(len(data) + 1):
            assert table.ids(size) == merge_bytes(data[:size], vocab.ranks)
        i = r.randrange(len(data))
        j = r.randrange(i, len(data) + 1)
        new = bytes(r.choice(b"abet hinson") for _ in range(r.randrange(9)))
        table.edit(i, j, new)
        fresh = PrefixTable(vocab, data[:i] + new + data[j:])
        assert table.last == fresh.last and table.data == fresh.data


def test_compatible_pairs_by_merging(vocab):
    r = random.Random(8)
    tokens = list(vocab.usable.values())
    left, right = r.choices(tokens, k=5000), r.choices(tokens, k=5000)
    for a, b, fits in zip(left, right, vocab.compatible(np.array(left), np.array(right))):
        joined = vocab.bytes_of[a] + vocab.bytes_of[b]
        assert fits == (merge_bytes(joined, vocab.ranks) == [a, b])


def test_codec_rows(spark, library):
    texts = [*AWKWARD, prose(1, 300), "a  b \n c  "]
    df = docs(spark, texts)
    got = sorted(map(tuple, bpe_codec(df, RANKS, P.PATTERN, outputs=("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")).collect()), key=repr)

    def want(ident, text):
        ids = library.encode_ordinary(text or "")
        data = (text or "").encode()
        joined = ",".join(map(str, ids)).encode()
        return (ident, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(data).hexdigest(), ids, bytearray(data))

    assert got == sorted((want(r.doc_id, r.text) for r in df.collect()), key=repr)
    assert bpe_codec(docs(spark, []), RANKS, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe_codec(df, RANKS, P.PATTERN, outputs=("words",))


def test_chunked_counts_equal_library():
    e = ChunkEncoder(WORD_BPE)
    r = random.Random(9)
    for _ in range(800):
        text = random_text(r, 60)
        want = len(e.lib.encode(text, add_special_tokens=False).ids)
        chunk = r.choice([5, 8, 20, 50])
        assert e.count(text, chunk, r.randrange(1, chunk)) == want, text
    assert e.count("x" * 5000, 100, 10) == len(e.lib.encode("x" * 5000, add_special_tokens=False).ids)


def test_long_texts_are_counted_from_their_chunks(monkeypatch):
    e = ChunkEncoder(WORD_BPE)
    e.words = None  # no word is looked up by itself
    encoded, whole = [], e._tokens
    monkeypatch.setattr(e, "_tokens", lambda text, lo, hi: encoded.append((lo, hi)) or whole(text, lo, hi))
    for text in (prose(4, 9000), "x" * 3000 + " " + prose(5, 500), "\n".join(prose(k, 40) for k in range(90)), " " * 4000 + "end"):
        encoded.clear()
        assert e.count(text, 1000, 50) == len(e.lib.encode(text, add_special_tokens=False).ids)
        assert len(encoded) > 2 and sum(hi - lo for lo, hi in encoded) >= len(text)
        assert set(range(len(text))) == {p for lo, hi in encoded for p in range(lo, hi)}


def test_count_rows(spark):
    e = ChunkEncoder(WORD_BPE)
    df = docs(spark, [*AWKWARD, prose(2, 3000)])
    got = sorted(map(tuple, token_counts(df, WORD_BPE, chunk_chars=500, overlap_chars=20).collect()), key=repr)

    def want(r):
        n = len(e.lib.encode(r.text or "", add_special_tokens=False).ids)
        return (r.doc_id, len((r.text or "").encode()), n, n > 2048)

    assert got == sorted(map(want, df.collect()), key=repr)
    assert token_counts(docs(spark, []), WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        token_counts(df, WORD_BPE, chunk_chars=10, overlap_chars=10)
