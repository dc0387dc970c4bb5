"""Operator 6 against a window search."""

import hashlib
import random

from sluice.llm.common import alnum_words
from sluice.llm.decontaminate import SuffixAutomaton, contamination, remove_contamination, word_places

from .frames import AWKWARD, docs, prose


def brute(words, items, window):
    hit, found = set(), set()
    for name, w in items:
        if w:
            for i in range(max(1, len(w) - window + 1)):
                run = w[i : i + window]
                for j in range(len(words) - len(run) + 1):
                    if words[j : j + len(run)] == run:
                        hit |= set(range(j, j + len(run)))
                        found.add(name)
    return hit, found


def test_automaton_equals_window_search():
    r = random.Random(1)
    letters = [b"a", b"b", b"c", b"d"]
    for _ in range(1500):
        window = r.choice([2, 3, 4])
        items = [(str(i), [r.choice(letters) for _ in range(r.randrange(8))]) for i in range(r.randrange(5))]
        words = [r.choice([*letters, b"z"]) for _ in range(r.randrange(30))]
        spans, found = SuffixAutomaton(items, window).matches(words)
        assert ({p for a, b in spans for p in range(a, b)}, found) == brute(words, items, window)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_word_places_are_those_of_the_words():
    r = random.Random(2)
    for _ in range(300):
        data = "".join(r.choice("aB9é ._-\n日") for _ in range(r.randrange(30))).encode()
        assert [data[a:b].lower() for a, b in word_places(data)] == [w for w in alnum_words(data)]


ITEMS = [(1, prose(50, 20)), (2, prose(51, 13)), (10, "Only, four. words here"), (3, None), (None, prose(52, 15)), (4, ""), (2, prose(51, 13))]


def items_frame(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def texts():
    five = prose(50, 20)
    return [
        *AWKWARD, five, five.upper(), "x " + five + " y", prose(1, 400) + " " + prose(51, 13), prose(2, 100) + " " + prose(51, 13),
        prose(3, 30) + " only FOUR words, here " + prose(4, 5), prose(52, 15), " ".join(five.split()[:12]), " ".join(five.split()[3:16]),
    ]


def test_rows(spark):
    df = docs(spark, texts())
    items = [("null" if i is None else str(i), alnum_words((t or "").encode())) for i, t in ITEMS]

    def want(ident, text):
        words = alnum_words((text or "").encode())
        hit, found = brute(words, items, 13)
        names = ",".join(sorted(found))
        return (ident, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))

    expected = sorted((want(r.doc_id, r.text) for r in df.collect()), key=repr)
    assert sum(e[5] for e in expected) >= 6
    for block_words in (2_000_000, 25):  # one block; several, merged
        got = contamination(df, items_frame(spark), block_words=block_words)
        assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_empty_tables(spark):
    assert contamination(docs(spark, []), items_frame(spark)).count() == 0
    got = contamination(docs(spark, ["a b"]), items_frame(spark, [])).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]


def test_removal_cuts_contaminated_spans_only(spark):
    df = docs(spark, texts())
    got = remove_contamination(df, items_frame(spark))
    assert got.schema == df.schema
    flags = {(r.doc_id, r.text): r for r in df.collect()}
    judged = {}
    for r, c in zip(df.orderBy("doc_id", "text").collect(), contamination(df.orderBy("doc_id", "text").coalesce(1), items_frame(spark)).collect()):
        judged[r.doc_id, r.text] = c
    left = got.collect()
    for r in left:
        if (r.doc_id, r.text) in flags:
            assert not judged[r.doc_id, r.text].contaminated
        else:
            assert r.n_chars == len(r.text)
    again = contamination(got, items_frame(spark)).where("contaminated").count()
    assert again == 0
    # wholly contaminated texts go, partly contaminated ones stay shortened
    gone = sum(c.contaminated and c.n_hit == c.n_words for c in judged.values())
    assert len(left) == df.count() - gone and gone >= 3


def test_removal_is_the_same_with_any_number_of_blocks(spark):
    rows = [(1, "a b c"), (2, "x y z"), (3, "k l m"), (4, "u v w")]
    # cutting 2 forms 1, whose cutting forms 3; 1 is of an earlier block than 2
    texts = ["a b x y z c", "one k a b x y z c l m two three", "u a x y z b c v w end", "x y z and more", "nothing here", None, "", "a b c"]
    got = []
    for block_words in (2_000_000, 3):
        out = remove_contamination(docs(spark, texts), items_frame(spark, rows), window=3, block_words=block_words)
        assert out.schema == docs(spark, texts).schema
        got.append(sorted(map(tuple, out.collect()), key=repr))
    assert got[0] == got[1] and [r.text.split() for r in out.collect() if r.doc_id == 1] == [["one", "two", "three"]]
