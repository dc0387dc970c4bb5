"""Operator 3 against a plain model in Python."""

import collections
import math
import zlib

import numpy as np

from sluice.llm.interpolation_lm import NEVER, STEPS, context_bucket, interpolated_scores, learn_weights

from .frames import AWKWARD, docs, prose


def plain_base(rows):
    words = [((i, t), (t or "").encode().lower().split() + ["END"]) for i, t in rows]
    rem = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    c = collections.Counter(w for (i, _), ws in words if rem(i) for w in ws)
    n, v = sum(c.values()), len(c)
    out = []
    for (i, _), ws in words:
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        out.append((i, rem(i) == 0, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out, key=repr)


def test_counts_and_base_scores(spark):
    texts = [*AWKWARD, *(prose(k, 30 + k) for k in range(60)), prose(3, 33), " end END \n end"]
    df = docs(spark, texts)
    want = plain_base([(r.doc_id, r.text) for r in df.collect()])
    for settings in ({}, {"block_tokens": 7, "bucket_keys": 40}):  # one block; texts over many blocks
        got = interpolated_scores(df, **settings).collect()
        rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
        assert sorted(rows, key=repr) == want
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_blocks_do_not_change_scores(spark):
    df = docs(spark, [prose(k, 50) for k in range(80)], slices=2)
    one = {r.doc_id: r.score for r in interpolated_scores(df).collect()}
    many = {r.doc_id: r.score for r in interpolated_scores(df, block_tokens=9, bucket_keys=30).collect()}
    assert one.keys() == many.keys()
    assert all(math.isclose(one[k], many[k], rel_tol=1e-9) for k in one)


def test_scores_are_the_mixture(spark):
    """Recomputes every score from plain counts and the weights learned from them."""
    texts = [prose(k % 25, 40) for k in range(120)]
    df = docs(spark, texts)
    rem = lambda i: zlib.crc32(str(i).encode()) % 10
    seqs = {k: ["E", *t.lower().split(), "E"] for k, t in enumerate(texts)}

    def counts(keep):
        uni, bi = collections.Counter(), collections.Counter()
        for k, s in seqs.items():
            if keep(rem(k)):
                uni.update(s[1:])
                bi.update(zip(s, s[1:]))
        return uni, bi

    kept, kept2 = counts(lambda r: 0 < r < 9)
    every, every2 = counts(lambda r: r > 0)
    nk, n, v = sum(kept.values()), sum(every.values()), len(every)
    bins = collections.Counter()
    bucket = lambda x: int(context_bucket(np.array([x]))[0])
    for k, s in seqs.items():
        if rem(k) == 9:
            for a, b in zip(s, s[1:]):
                cu, cv, cuv = kept[a], kept[b], kept2[a, b]
                pair = round(STEPS * math.log2(cuv / cu * nk / cv)) if cuv else NEVER
                word = round(STEPS * math.log2(cv / nk * (v + 1))) if cv else NEVER
                bins[bucket(cu), pair, word] += 1
    learned = learn_weights([(*k, c) for k, c in bins.items()])
    near = lambda b: learned[min(learned, key=lambda k: (abs(k - b), k))]
    for r in interpolated_scores(df).collect():
        total = 0.0
        for a, b in zip(seqs[r.doc_id], seqs[r.doc_id][1:]):
            w = near(bucket(every[a]))
            total += math.log10(w[0] * every2[a, b] / max(1, every[a]) + w[1] * every[b] / n + w[2] / (v + 1))
        assert math.isclose(total, r.score, rel_tol=1e-9)


def test_learned_weights_raise_the_likelihood():
    bins = [(3, 8, 12, 500), (3, NEVER, 12, 300), (3, NEVER, NEVER, 5), (4, NEVER, 4, 10)]
    w = learn_weights(bins)
    assert all(math.isclose(sum(x), 1) and min(x) >= 0 for x in w.values())

    def likelihood(x):
        return sum(n * math.log(x[0] * (0 if p == NEVER else 2 ** (p / STEPS)) * (0 if q == NEVER else 2 ** (q / STEPS))
                                + x[1] * (0 if q == NEVER else 2 ** (q / STEPS)) + x[2]) for b, p, q, n in bins if b == 3)

    best = likelihood(w[3])
    for other in ((1 / 3, 1 / 3, 1 / 3), (0.8, 0.1, 0.1), (0.1, 0.8, 0.1)):
        assert best >= likelihood(other)


def test_model_beats_base_on_held_out_texts(spark):
    pairs = [f"w{i} w{i + 1} w{i + 2}" for i in range(0, 90, 3)]
    df = docs(spark, [prose(k, 60, pairs) for k in range(200)])
    held = [r for r in interpolated_scores(df).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_empty_and_untrained(spark):
    assert interpolated_scores(docs(spark, [])).count() == 0
    only_held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    got = interpolated_scores(docs(spark, [(k, "a b") for k in only_held])).collect()
    assert {(r.n_known, r.train_tokens, round(r.score, 6)) for r in got} == {(0, 0, round(3 * math.log10(0.5), 6))} or all(
        r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got
    )
