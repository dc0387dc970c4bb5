"""Operator 10 against counting in Python."""

import collections
import random
import re

from pyspark.sql import functions as F

from sluice.llm.quality_cascade import Rule, drawn, keep_good, measured_order, quality, rejecting_rule

from .frames import AWKWARD, docs, prose


def counted(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    marked = {i + k for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    n, symbols, dup, rep, chars = len(w), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(marked), sum(map(len, w))
    failed = n < 50 or 100 * rep > 50 * n
    upper, marks = sum("A" <= c <= "Z" for c in text), text.count("!")
    bad = (failed or 10 * symbols > n or 2 * dup > len(lines) or 5 * upper > 2 * len(text) or 10 * marks > 3 * n
           or chars < 2 * n or chars > 15 * n)
    return n, chars, symbols, dup, rep, failed, not bad


def texts():
    r = random.Random(1)
    out = [*AWKWARD, "a\x0bb\x0cc\rd\x1ce\x85f g"]
    for k in range(40):
        t = prose(k, r.randrange(30, 200))
        out += [t, t + "\n" + t[:80] + "\n" + t[:80], t.upper(), t.replace(" ", " | "), t + "!" * r.randrange(90)]
        out.append("\n".join([prose(k, 8)] * r.randrange(2, 12)))
        out.append(prose(k, 120, ["a", "b", "c", "dd"]))
        out.append(prose(k, 60, ["x" * 30, "y" * 20]) + " 日本 語𝄞")
    return out


def test_counts_and_verdicts(spark):
    df = docs(spark, texts())
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted(map(tuple, quality(df, sample_rows=50).select("doc_id", *cols).collect()), key=repr)
    assert got == sorted(((r.doc_id, *counted(r.text)) for r in df.collect()), key=repr)


def test_keep_good_keeps_columns_and_good_rows(spark):
    df = docs(spark, texts()).withColumn("__words", F.lit(1))
    got = keep_good(df, sample_rows=50)
    assert got.schema == df.schema
    key = lambda rows: sorted(((r.doc_id, r.text) for r in rows), key=repr)
    assert key(got.collect()) == key([r for r in df.collect() if counted(r.text)[-1]])
    assert keep_good(docs(spark, [])).count() == 0 and quality(docs(spark, [])).count() == 0


def test_order_by_rejection_per_cost(spark):
    df = docs(spark, [str(k) for k in range(100)])
    slow = F.size(F.filter(F.sequence(F.lit(1), F.lit(60_000)), lambda x: F.sha2(x.cast("string"), 256) == "")) > 0
    rules = [Rule("never", F.col("text") == "no"), Rule("slow", (F.col("text").cast("int") < 90) | slow), Rule("fast", F.col("text").cast("int") < 90)]
    order = measured_order(df, rules)
    assert [r.name for r, _, _ in order][-1] == "never" and [s for r, s, _ in order if r.name == "fast"] == [0.9]
    names = [r.name for r, _, _ in order]
    assert names.index("fast") < names.index("slow")
    # whatever the order, the verdict is the same
    for perm in (rules, rules[::-1]):
        assert df.where(rejecting_rule(perm).isNull()).count() == 10


def test_main_path_is_native(spark):
    plan = quality(docs(spark, ["a b c"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sample_is_drawn_over_the_whole_table(spark):
    # the first source, stored first, is unlike the others
    df = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") < 4000, "hot").otherwise("other").alias("text"))
    (_, share, _), = measured_order(df, [Rule("hot", F.col("text") == "hot")], sample_rows=400)
    assert 0.35 < share < 0.65
    assert drawn(df, 400).count() == 400 and drawn(df.limit(30), 400).count() == 30 and drawn(df.limit(0), 400).count() == 0


def test_order_counts_what_earlier_rules_leave(spark):
    df = docs(spark, [str(k) for k in range(100)])
    n = F.col("text").cast("int")
    dear = F.size(F.filter(F.sequence(F.lit(1), F.lit(20_000)), lambda x: F.sha2(x.cast("string"), 256) == "")) > 0
    # the second rejects nearly what the first does, the third other rows
    rules = [Rule("most", n < 80), Rule("same", (n < 79) | dear), Rule("others", (n >= 85) | dear)]
    got = {r.name: (place, share) for place, (r, share, _) in enumerate(measured_order(df, rules))}
    assert got["most"] == (0, 0.8) and got["others"] == (1, 0.75) and got["same"] == (2, 0.0)
    assert [share for _, share, _ in measured_order(df.limit(0), rules)] == [0.0] * 3
