"""Operator 4 against all pairs."""

import random

from sluice.llm.jaccard_join import components, keep_one_of_each, near_duplicates

from .frames import AWKWARD, docs, prose


def brute(rows, n=5, num=3, den=4):
    """(id, text) -> sorted (id, n_shingles, component)."""
    sets = []
    for ident, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((ident, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            both = len(a & b)
            if both and both * den >= num * (len(a) + len(b) - both):
                up[find(i)] = find(j)
    out = []
    for i, (ident, s) in enumerate(sets):
        ids = [k for j, (k, _) in enumerate(sets) if find(j) == find(i) and k is not None]
        out.append((ident, len(s), None if ident is None else min(ids)))
    return sorted(out, key=repr)


def check(df, **settings):
    got = sorted(map(tuple, near_duplicates(df, **settings).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])


def edited(text, r, edits):
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_families_passages_and_awkward_rows(spark):
    r = random.Random(1)
    passage = prose(99, 30)
    texts = [x for x in AWKWARD if not isinstance(x, tuple)]
    for k in range(6):
        base = prose(k, 40 + 30 * k, [f"w{i}" for i in range(400)])
        texts += [base, base.upper(), base + "\n"]
        texts += [edited(base, r, e) for e in (1, 1, 2, 2, 3)]
        # a chain: neighbours alike, ends not
        step = base
        for _ in range(6):
            step = edited(step, r, 1)
            texts.append(step)
        texts.append(passage + " " + prose(100 + k, 20, [f"v{i}" for i in range(400)]))
    r.shuffle(texts)
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    check(docs(spark, [*rows, (None, passage), (None, None), (7, "same id"), (7, "same id")]), bucket_keys=300)


def test_large_group_of_near_copies(spark):
    r = random.Random(2)
    base = prose(5, 120, [f"w{i}" for i in range(900)])
    texts = [edited(base, r, 2) for _ in range(120)] + [base] * 40
    check(docs(spark, texts), bucket_keys=1000)


def test_threshold_is_inclusive(spark):
    # 7 of 7 + ... shingles: 6 shared of 8 together is exactly three quarters
    a = " ".join(f"a{i}" for i in range(11))
    b = " ".join([*(f"a{i}" for i in range(10)), "z"])
    check(docs(spark, [a, b, a + " a11 a12", a.replace("a5", "q")]))


def test_empty_and_all_empty_texts(spark):
    assert near_duplicates(docs(spark, [])).count() == 0
    check(docs(spark, [None, "", " "]))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    got = {r.node: r.comp for r in components(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}


def test_keep_one_of_each(spark):
    base = prose(3, 60, [f"Word{i}" for i in range(80)])
    df = docs(spark, [(5, base), (3, base.upper()), (9, prose(4, 60)), (9, prose(4, 60)), (None, base), (2, None), (4, None)])
    got = keep_one_of_each(df)
    assert got.schema == df.schema
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted([3, 9, None, 2, 4], key=repr)
