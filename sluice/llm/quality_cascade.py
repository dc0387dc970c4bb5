"""Quality rules as a short-circuit cascade (operator 10), built-in functions only.

Every rule is a boolean column over the text that says "reject".  On a sample of at
most ``sample_rows`` rows, drawn over the whole table, each rule's cost (seconds above those of reading the
sample) and selectivity (share of rows rejected) are measured; the rules are then
ordered by rejection per cost and evaluated as one CASE, which stops at the first
rule that rejects.  The order changes the time, never the verdict.

Results for edge cases: a null text counts as empty, has no words, and fails; rows
with a null id and repeated rows are judged like any other; an empty table stays
empty (rules then keep their given order); ``keep_good`` returns exactly the
columns it got, whatever their names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged

BLANK = "[\\x20\\x09-\\x0D]"
WORDED = "[^\\x20\\x09-\\x0D]"
SYMBOL = "[#*$%&|<>]"


def plain(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.array_remove(F.split(plain(text), BLANK + "+"), "")


def occurrences(text: Column, pattern: str) -> Column:
    """Characters that match a one-character pattern."""
    return (F.length(plain(text)) - F.length(F.regexp_replace(plain(text), pattern + "+", ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(plain(text), BLANK + "+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return occurrences(text, SYMBOL)


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(plain(text), "\n", -1), lambda x: x.rlike(WORDED))


def n_dup_lines(lines: Column) -> Column:
    """Lines equal to an earlier one."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def n_repeat_words(w: Column) -> Column:
    """Words covered by three-word windows that occur at least twice in the text.

    Each window becomes one number: the upper bits of its hash, the lower bits its
    position.  Sorted, equal windows are neighbours; a pair of neighbours with equal
    upper bits is compared word by word, and marks its six words; the distinct marks
    are counted.  Linear but for the sort of the numbers, and within the row: no
    window leaves its document.  (An equal pair is missed only if a different window
    with the same upper bits, 64 less the bits of a position, lies between.)"""

    def of_words(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        span = F.pow(F.lit(2.0), F.ceil(F.log2(F.size(w).cast("double") + 1))).cast("long")  # over any position

        def tagged(p: Column) -> Column:
            def tag(x: Column, i: Column) -> Column:
                h = F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
                return h.bitwiseAND(-p).bitwiseOR(i.cast("long"))

            return F.sort_array(F.transform(F.slice(w, 1, n), tag))

        def count(s: Column, p: Column) -> Column:
            m = F.greatest(F.size(s) - 1, F.lit(0))

            def same(i: Column, j: Column) -> Column:
                return (
                    (F.get(w, i) == F.get(w, j))
                    & (F.get(w, i + 1) == F.get(w, j + 1))
                    & (F.get(w, i + 2) == F.get(w, j + 2))
                )

            def marks(a: Column, b: Column) -> Column:
                i = a.bitwiseAND(p - 1).cast("int")
                j = b.bitwiseAND(p - 1).cast("int")
                near = a.bitwiseAND(-p) == b.bitwiseAND(-p)
                return F.when(near, F.when(same(i, j), F.array(i, i + 1, i + 2, j, j + 1, j + 2)))

            pairs = F.zip_with(F.slice(s, 1, m), F.slice(s, 2, m), marks)
            return F.size(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

        return bound(span, lambda p: bound(tagged(p), lambda s: count(s, p)))

    return bound(w, of_words).cast("long")


@dataclass(frozen=True)
class Rule:
    """``reject`` is true where a row must go (null counts as false)."""

    name: str
    reject: Column


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat > 50 * n_words)


def default_rules(text: Column, w: Column, n_repeat: Column) -> list[Rule]:
    """The rules of the registered query; thresholds are shares of words, lines or characters."""
    n = F.size(w)
    return [
        Rule("few_words", n < 50),
        Rule("symbols", 10 * n_symbols(text) > n),
        Rule("duplicate_lines", bound(worded_lines(text), lambda x: 2 * n_dup_lines(x) > F.size(x))),
        Rule("capitals", 5 * occurrences(text, "[A-Z]") > 2 * F.length(plain(text))),
        Rule("exclamations", 10 * occurrences(text, "!") > 3 * n),
        Rule("word_length", (word_chars(text) < 2 * n) | (word_chars(text) > 15 * n)),
        Rule("repeated_windows", 100 * n_repeat > 50 * n),
    ]


def drawn(docs: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """At most ``rows`` rows drawn evenly over all of ``docs``.  Only about four times as
    many are moved: the others go where they are read."""
    share = min(1.0, 4.0 * rows / max(1, docs.count()))
    return docs.withColumn("__draw", F.rand(seed)).where(F.col("__draw") < share).orderBy("__draw").limit(rows).drop("__draw")


COPIES, ROUNDS = 3, 3  # a rule is timed over so many copies of the sample, so many times


def measured_order(docs: DataFrame, rules: list[Rule], sample_rows: int = 400) -> list[tuple[Rule, float, float]]:
    """(rule, share, seconds), next the rule that rejects most per second of what the
    rules before it leave; ``share`` is its share of the rows that come to it.

    Seconds are the least of several interleaved runs over copies of the sample, less what a
    job without a rule takes; which rules reject a row together is counted in one job."""
    sample = staged(docs.sparkSession, drawn(docs, sample_rows), "quality-sample")
    copies = sample.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def verdict(rule: Rule) -> Column:
        return F.coalesce(rule.reject, F.lit(False)).cast("long")

    def seconds(column: Column) -> float:
        began = time.perf_counter()
        copies.agg(F.sum(column)).first()
        return time.perf_counter() - began

    mask = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        mask = mask + F.shiftleft(verdict(rule), i)
    left = {r["mask"]: r["count"] for r in sample.groupBy(mask.alias("mask")).count().collect()}
    everything = sum(left.values())
    runs = [[seconds(c) for c in (F.length(sample.columns[0]), *map(verdict, rules))] for _ in range(ROUNDS)]
    floor, *took = map(min, zip(*runs))
    cost = [max(t - floor, 1e-3) for t in took]
    whole = [sum(n for m, n in left.items() if m >> i & 1) / max(1, everything) for i in range(len(rules))]
    todo, found = list(range(len(rules))), []
    while todo:
        rows = sum(left.values())
        share = {i: sum(n for m, n in left.items() if m >> i & 1) / rows if rows else 0.0 for i in todo}
        best = max(todo, key=lambda i: (share[i] / cost[i], whole[i] / cost[i], -i))
        found.append((rules[best], share[best], cost[best]))
        left = {m: n for m, n in left.items() if not m >> best & 1}
        todo.remove(best)
    return found


def rejecting_rule(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null for rows that stay."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        out = out.when(F.coalesce(rule.reject, F.lit(False)), F.lit(rule.name))
    return out


def measured_rules(docs: DataFrame, text_col: str, sample_rows: int) -> list[str]:
    """Names of the default rules in measured order, each over the bare text."""
    text = F.col(text_col)
    rules = default_rules(text, words(text), n_repeat_words(words(text)))
    return [rule.name for rule, _, _ in measured_order(docs.select(text_col), rules, sample_rows)]


def keep_good(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = 400) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are.  ``rules`` of
    one's own refer to columns of ``docs``."""
    if rules is not None:
        order = [rule for rule, _, _ in measured_order(docs, rules, sample_rows)]
        return docs.where(rejecting_rule(order).isNull())
    names = measured_rules(docs, text_col, sample_rows)
    w = "__words"
    while w in docs.columns:
        w += "_"
    own = {r.name: r for r in default_rules(F.col(text_col), F.col(w), n_repeat_words(F.col(w)))}
    split = docs.withColumn(w, words(F.col(text_col)))
    return split.where(rejecting_rule([own[n] for n in names]).isNull()).select(*docs.columns)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 400) -> DataFrame:
    """Counts and verdict for every row of ``docs``: ``rejected_by`` is the first rule of
    the measured order that rejects the text, null if none does."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = measured_rules(own, "text", sample_rows)
    t, w = F.col("text"), F.col("w")
    counted = own.withColumn("w", words(t)).withColumn("n_repeat_words", n_repeat_words(w))
    rules = {r.name: r for r in default_rules(t, w, F.col("n_repeat_words"))}
    judged = counted.select(
        F.col("id").alias(id_col),
        F.size("w").cast("long").alias("n_words"),
        word_chars(t).alias("word_chars"),
        n_symbols(t).alias("n_symbols"),
        bound(worded_lines(t), n_dup_lines).alias("n_dup_lines"),
        "n_repeat_words",
        rejecting_rule([rules[n] for n in names]).alias("rejected_by"),
    )
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & F.col("rejected_by").isNull()
    )
