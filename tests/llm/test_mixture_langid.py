"""Operator 8: held-out accuracy, mixtures and awkward rows."""

import zlib

from sluice.llm.mixture_langid import languages, learn, predict

from .frames import AWKWARD, SCHEMA, prose

VOCABULARY = {
    "aa": "the and that with from this have not are was for which when house water".split(),
    "bb": "der die und nicht das ein von für mit sich auch haus wasser über schön".split(),
    "cc": "los que una por para con del como más pero agua casa niño está también".split(),
}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "x", "x", "x", "x", None) for i, t, lang in rows], SCHEMA)


def labelled(n=240):
    langs = sorted(VOCABULARY)
    return [(k, prose(k, 25, VOCABULARY[langs[k % 3]]), langs[k % 3]) for k in range(n)]


def test_held_out_accuracy_and_awkward_rows(spark):
    plain = labelled()
    odd = [(1000 + k, t if not isinstance(t, tuple) else t[1], None) for k, t in enumerate(AWKWARD)]
    odd += [(None, prose(5, 20, VOCABULARY["bb"]), "bb"), (2000, "123 !!!", "aa"), (2001, "Ünd", "aa")]
    got = languages(frame(spark, plain + odd)).collect()
    assert len(got) == len(plain) + len(odd)
    want = {i: lang for i, _, lang in plain}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 50 and all(r.lang_pred == want[r.doc_id] for r in held)
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {i for i, t, _ in odd if not any(map(str.isalpha, t or ""))}


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = labelled()
    lies = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    one = {r.doc_id: tuple(r) for r in languages(frame(spark, rows)).collect()}
    two = {r.doc_id: tuple(r) for r in languages(frame(spark, lies)).collect()}
    assert one == two


def test_mixture_proportions(spark):
    model = learn(frame(spark, labelled()))
    text = prose(1, 120, VOCABULARY["aa"]) + " " + prose(2, 60, VOCABULARY["cc"])
    found = dict(model.mixture(text))
    assert set(found) == {"aa", "cc"} and 0.5 < found["aa"] < 0.8
    assert [x for x, _ in model.mixture(prose(9, 40, VOCABULARY["bb"]))] == ["bb"]
    share, likelihood = model.proportions(model.like[:, :50], __import__("numpy").ones(50), __import__("numpy").full(3, 1 / 3))
    assert abs(share.sum() - 1) < 1e-9 and likelihood < 0


def test_nothing_to_learn_and_empty(spark):
    df = frame(spark, [(1, "some text", None), (2, None, "aa")])
    assert {(r.lang_pred, r.score) for r in languages(df).collect()} == {("und", 0.0)}
    assert languages(df.limit(0)).count() == 0
    got = predict(df, learn(frame(spark, labelled()))).collect()
    assert {r.doc_id: len(r.languages) for r in got} == {1: len(got[0].languages) if got[0].doc_id == 1 else len(got[1].languages), 2: 0}
