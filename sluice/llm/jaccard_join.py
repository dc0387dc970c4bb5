"""N-gram Jaccard self-join with several global token orders (operator 4).

A document's set is that of its distinct word n-grams, as 64-bit hashes.  Documents
with the same words in the same order form a class at once, named by their smallest
id; the rest works on classes:

1. *Shared n-grams.*  Blocks of classes ask hash ranges which of their n-grams others
   have (``shared_tokens``).  A class whose shared n-grams are fewer than its smallest
   possible overlap cannot link and leaves.  Equal documents in several blocks count as
   several here, so some n-grams of one class only stay; step 3 asks again, by component.
2. *Prefixes.*  Of ``s`` shared n-grams of which a link needs at least ``a``, two linked
   classes must both hold one of each other's first ``s - a + 1`` under any order.
   Candidates meet on a prefix token of the first order (rarest first) and must
   also share a prefix token under each of the other, independent orders, before the
   overlap is counted (exactly, on the whole sets).
3. *Links without all pairs.*  First every class is compared with one hub for each of a
   few of its tokens, and what links is joined to components.  Then only prefix
   tokens that still hold more than one component are looked at, and only pairs of
   classes from different components are formed.  Links inside a component cannot
   change the components; no link between two components is lost.

Nothing is capped: a token held by many classes costs one hub comparison each, and
pairs only between components.

Results for edge cases: null and empty texts and texts without words have
``n_shingles`` 0 and are their own component; texts of fewer words than an n-gram are
one n-gram; equal documents and repeated rows share a component; rows with a null id
cannot be named: they keep ``component_id`` null and lend their id to nobody; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import arrow_map, mix64, ngram_hashes, power_of_two, staged, text_input, unstage, word_hashes
from sluice.llm.shared_tokens import I64, U32, U64, Sets, answers, expand, holders_of, rarest_first, squeeze


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text's word hashes; the whole text as one
    if it has fewer words, nothing if it has none."""
    if len(h) >= n:
        return np.unique(ngram_hashes(h, n))
    if len(h) == 0:
        return h
    return mix64(ngram_hashes(h, len(h)) + np.uint64(len(h)))


def signature(h: np.ndarray) -> bytes:
    """Names a sequence of words."""
    return xxhash.xxh3_128_digest(h.tobytes())


def least_overlap(n, num: int, den: int):
    """Smallest overlap of a set of ``n`` with any set of similarity ``num / den``."""
    return -(-n * num // den)


# ------------------------------------------------------------------ blocks of texts
def _text_blocks(limit: int, id_type: pa.DataType):
    """Texts gathered to blocks of about ``limit`` words (at most as many documents): the documents' ids and classes,
    and the words of each class as numbers into the block's distinct words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, cls, sigs, words, total = [], [], {}, [], 0

        def block() -> pa.RecordBatch:
            lens = np.array([len(h) for h in words], U32)
            distinct, index, counts = np.unique(
                np.concatenate([np.empty(0, U64), *words]), return_inverse=True, return_counts=True
            )
            order = np.argsort(-counts, kind="stable")  # frequent words get small numbers
            place = np.empty(len(order), U32)
            place[order] = np.arange(len(order), dtype=U32)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(id_type)),
                pa.array([np.array(cls, np.int32).tobytes()], pa.binary()),
                pa.array([b"".join(sigs)], pa.binary()),
                pa.array([squeeze(lens)], pa.binary()),
                pa.array([distinct[order].tobytes()], pa.binary()),
                pa.array([squeeze(place[index.reshape(-1)])], pa.binary()),
                pa.array([total], pa.int64()),
            ], names=[c.split()[0] for c in TEXT_BLOCK.split(", ")])

        for batch in batches:
            for ident, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                h = word_hashes(text or b"")
                ids.append(ident)
                if not len(h):
                    cls.append(-1)
                else:
                    sig = signature(h)
                    if sig not in sigs:
                        sigs[sig] = len(sigs)
                        words.append(h)
                        total += len(h)
                    cls.append(sigs[sig])
                if total >= limit or len(ids) >= limit:
                    yield block()
                    number += 1
                    ids, cls, sigs, words, total = [], [], {}, [], 0
        if ids:
            yield block()

    return run


TEXT_BLOCK = "block bigint, ids array<bigint>, cls binary, sigs binary, lens binary, words binary, places binary, n_words bigint"


def _text_sets(n: int):
    """The sets of a block's classes, from their words."""

    def sets_of(row: dict) -> Sets:
        h = np.frombuffer(row["words"], U64)[expand(row["places"], U32)]
        lens = expand(row["lens"], U32).astype(np.int64)
        grams = ngram_hashes(h, n)
        ends = np.cumsum(lens)
        sets = [
            np.unique(grams[e - m : e - n + 1]) if m >= n else shingle_set(h[e - m : e], n)
            for m, e in zip(lens.tolist(), ends.tolist())
        ]
        return Sets(np.concatenate([np.empty(0, U64), *sets]), np.array([len(s) for s in sets], np.int64))

    return sets_of


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, sig, block, pos) of every document of the blocks; sig is null without words."""
    for batch in batches:
        for block, ids, cls, sigs in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "cls", "sigs"))):
            at = np.frombuffer(cls, np.int32).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()),
                pa.array([sigs[16 * p : 16 * p + 16] if p >= 0 else None for p in at], pa.binary()),
                pa.array([block] * len(at), pa.int64()),
                pa.array(at, pa.int32()),
            ], names=["id", "sig", "block", "pos"])


CLASS_SETS = "sig binary, rep bigint, n int, keys binary"


def _class_sets(n: int, buckets: int, num: int, den: int):
    """The classes that a block stands for, with their shared n-grams if these are enough
    for a link, else null."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"sig": [], "rep": [], "n": [], "keys": []}
        told = [r for r in right.to_pylist() if r["codes"] is not None]
        reps = {r["pos"]: r["rep"] for r in right.select(["pos", "rep"]).to_pylist() if r["pos"] is not None}
        for row in left.to_pylist():
            sets = _text_sets(n)(row)
            holders = holders_of(sets, [(r["bucket"], r["codes"]) for r in told], buckets)
            good, found = rarest_first(sets, holders, least_overlap(sets.lens, num, den))
            found = dict(zip(np.flatnonzero(good).tolist(), found))
            for pos, rep in reps.items():
                out["sig"].append(row["sigs"][16 * pos : 16 * pos + 16])
                out["rep"].append(rep)
                out["n"].append(int(sets.lens[pos]))
                out["keys"].append(found.get(pos))
        types = (pa.binary(), pa.int64(), pa.int32(), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    return run


# ------------------------------------------------------------------ blocks of sets
SET_BLOCK = "block bigint, reps binary, comps binary, ns binary, lens binary, keys binary, n_keys bigint"
LABELLED = "rep bigint, comp bigint, n int, keys binary"


def _set_blocks(limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        reps, comps, ns, sets, total = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            lens = np.array([len(k) // 8 for k in sets], U32)
            data = [np.array(x, t).tobytes() for x, t in ((reps, I64), (comps, I64), (ns, U32))]
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()),
                *(pa.array([x], pa.binary()) for x in (*data, lens.tobytes(), b"".join(sets))),
                pa.array([total], pa.int64()),
            ], names=[c.split()[0] for c in SET_BLOCK.split(", ")])

        for batch in batches:
            for rep, comp, n, keys in zip(*(batch.column(c).to_pylist() for c in ("rep", "comp", "n", "keys"))):
                reps.append(rep)
                comps.append(comp)
                ns.append(n)
                sets.append(keys)
                total += len(keys) // 8
                if total >= limit:
                    yield block()
                    number += 1
                    reps, comps, ns, sets, total = [], [], [], [], 0
        if reps:
            yield block()

    return run


def _labelled_sets(row: dict) -> Sets:
    return Sets(
        np.frombuffer(row["keys"], U64),
        np.frombuffer(row["lens"], U32).astype(np.int64),
        np.frombuffer(row["comps"], I64),
    )


def _open_sets(buckets: int, num: int, den: int):
    """Classes with enough n-grams that another component holds too."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"rep": [], "comp": [], "n": [], "keys": []}
        told = [(r["bucket"], r["codes"]) for r in right.to_pylist()]
        for row in left.to_pylist():
            sets, n = _labelled_sets(row), np.frombuffer(row["ns"], U32).astype(np.int64)
            good, found = rarest_first(sets, holders_of(sets, told, buckets), least_overlap(n, num, den))
            out["rep"] += np.frombuffer(row["reps"], I64)[good].tolist()
            out["comp"] += sets.comps[good].tolist()
            out["n"] += n[good].tolist()
            out["keys"] += found
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    return run


# ------------------------------------------------------------------ candidates
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # salts of the second and third order


def _prefix_size(shared, n, num: int, den: int):
    return shared - least_overlap(n, num, den) + 1


BITS = 16  # words of 64 bits in the parity map of a set

HELD = (
    "token bigint, at int, rep bigint, comp bigint, n int, shared int, "
    + ", ".join(f"m{i} bigint" for i in range(BITS))
)


def parity_map(k: np.ndarray) -> np.ndarray:
    """For each of the map's bits whether an odd number of the set's tokens fall on it:
    two maps differ in at most as many bits as the sets differ in tokens."""
    odd = np.bincount((mix64(k) % np.uint64(64 * BITS)).astype(np.int64), minlength=64 * BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _held_tokens(num: int, den: int):
    """A row for each prefix token of the first order, with its place and the class's map."""
    names = [c.split()[0] for c in HELD.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, comp, n, keys in zip(*(batch.column(c).to_pylist() for c in ("rep", "comp", "n", "keys"))):
                k = np.frombuffer(keys, np.int64)
                size = _prefix_size(len(k), n, num, den)
                same = [np.full(size, x, np.int64) for x in (rep, comp)]
                counts = [np.full(size, x, np.int32) for x in (n, len(k))]
                maps = [np.full(size, x, np.int64) for x in parity_map(k.view(U64))]
                columns = [k[:size], np.arange(size, dtype=np.int32), *same, *counts, *maps]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _pairs_between(held: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes from different components that may link, found at a prefix token.

    Kept are pairs whose sizes allow the similarity, whose places at the token leave
    enough tokens after it (true at the first token that two linked classes share), and
    whose parity maps do not show too many differing tokens.  Members of the component
    with most classes at a token are not compared with each other."""
    groups = held.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("members"))
    top = groups.groupBy("token").agg(F.max_by("comp", F.struct("members", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
    open_rows = held.join(top.where("comps > 1").select("token", "top"), "token")
    one = open_rows.where("comp != top").select("token", *(F.col(c).alias(f"{c}_1") for c in held.columns if c != "token"))
    two = open_rows.select("token", "top", *(F.col(c).alias(f"{c}_2") for c in held.columns if c != "token"))
    c = F.col
    both = c("n_1") + c("n_2")
    # overlap needed: num / (num + den) of the sum of the sizes, rounded up
    differ = both * (den - num)  # at most this over (num + den) tokens in one set only
    apart = sum((F.bit_count(c(f"m{i}_1").bitwiseXOR(c(f"m{i}_2"))) for i in range(BITS)), F.lit(0))
    alone = (c("n_1") - c("shared_1")) + (c("n_2") - c("shared_2"))
    after = F.least(c("shared_1") - c("at_1"), c("shared_2") - c("at_2"))
    close = (
        (c("comp_1") != c("comp_2"))
        & ((c("comp_2") == c("top")) | (c("rep_1") < c("rep_2")))
        & (F.least("n_1", "n_2") * den >= F.greatest("n_1", "n_2") * num)
        & (after * (num + den) >= both * num)
        & ((apart + alone) * (num + den) <= differ)
    )
    return one.join(two, (one["token"] == two["token"]) & close).select(
        F.least("rep_1", "rep_2").alias("a"), F.greatest("rep_1", "rep_2").alias("b")
    ).distinct()


def _meeting_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, rep): the first token of every order, where classes meet their hub."""
    for batch in batches:
        tokens, reps = [], []
        for rep, keys in zip(batch.column("rep").to_pylist(), batch.column("keys").to_pylist()):
            k = np.frombuffer(keys, U64)
            found = {int(k[0])} | {int(k[np.argmin(mix64(k ^ np.uint64(salt)))]) for salt in ORDERS}
            for t in found:
                tokens.append(t)
                reps.append(rep)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(tokens, U64).view(np.int64)), pa.array(reps, pa.int64())], names=["token", "rep"]
        )


def _linked(num: int, den: int):
    """Keeps pairs that meet in the prefixes of all further orders and then reach the
    similarity."""

    def prefix(k: np.ndarray, n: int, salt: int) -> np.ndarray:
        m = mix64(k ^ np.uint64(salt))
        size = _prefix_size(len(k), n, num, den)
        return np.partition(m, size - 1)[:size] if size < len(m) else m

    def similar(n1: int, k1: np.ndarray, n2: int, k2: np.ndarray) -> bool:
        if min(n1, n2) * den < num * max(n1, n2):
            return False
        for salt in ORDERS:
            if not np.isin(prefix(k1, n1, salt), prefix(k2, n2, salt)).any():
                return False
        both = len(np.intersect1d(k1, k2, assume_unique=True))
        return both * den >= num * (n1 + n2 - both)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n1, k1, n2, k2 = (batch.column(c).to_pylist() for c in ("a", "b", "n1", "k1", "n2", "k2"))
            keep = [
                similar(n1[i], np.frombuffer(k1[i], U64), n2[i], np.frombuffer(k2[i], U64)) for i in range(len(a))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, k in zip(a, keep) if k], pa.int64()), pa.array([x for x, k in zip(b, keep) if k], pa.int64())],
                names=["a", "b"],
            )

    return run


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that are linked."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n1"), F.col("keys").alias("k1"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n2"), F.col("keys").alias("k2"))
    return pairs.join(one, "a").join(two, "b").transform(arrow_map, _linked(num, den), "a bigint, b bigint")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links (a, b): comp is the smallest node that
    can be reached.  Every round takes the smallest label of the neighbours and then
    the label's own label; it ends when no label changes."""
    edges = staged(
        spark,
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        ),
        "near-edges",
    )
    before = labels = staged(spark, edges.groupBy(F.col("u").alias("node")).agg(F.least("u", F.min("v")).alias("comp")), "near-labels")
    while True:
        near = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("comp").alias("near"))
        lower = labels.join(near, labels["node"] == near["u"]).select("node", "comp", F.least("comp", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("comp").alias("higher"))
        moved = staged(
            spark, lower.join(up, "low").select("node", F.col("comp").alias("old"), F.least("low", "higher").alias("comp")), "near-labels"
        )
        unstage(spark, before)
        before, labels = moved, moved.select("node", "comp")
        if moved.where(F.col("old") != F.col("comp")).isEmpty():
            unstage(spark, edges)
            return labels


def _star_pairs(tokens: DataFrame) -> DataFrame:
    """Each class with the smallest class that holds the same token."""
    hubs = tokens.groupBy("token").agg(F.min("rep").alias("a"))
    return tokens.join(hubs, "token").where("a < rep").select("a", F.col("rep").alias("b")).distinct()


def _between_components(spark: SparkSession, sets: DataFrame, comps: DataFrame, bucket_keys: int, num: int, den: int) -> DataFrame:
    """(rep, comp, n, keys) of the classes that may still link to another component: only
    n-grams that two components have count, and those must be enough for a link."""
    own = sets.join(comps, sets["rep"] == comps["node"], "left").select("rep", F.coalesce("comp", "rep").alias("comp"), "n", "keys")
    blocks = staged(spark, own.transform(arrow_map, _set_blocks(bucket_keys), SET_BLOCK), "near-blocks")
    buckets = _buckets(blocks, "n_keys", bucket_keys)
    told = answers(blocks.select("block", "comps", "lens", "keys"), _labelled_sets, buckets)
    left = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_open_sets(buckets, num, den), LABELLED)
    found = staged(spark, left, "near-open")
    unstage(spark, blocks)
    return found


def _buckets(blocks: DataFrame, size: str, bucket_keys: int) -> int:
    return power_of_two((blocks.agg(F.sum(size)).first()[0] or 0) // bucket_keys + 1)


def linked_components(spark: SparkSession, sets: DataFrame, num: int, den: int, bucket_keys: int = 2_000_000) -> DataFrame:
    """(node, comp) over the classes of ``sets`` (rep, n, keys) that have links."""
    tokens = sets.transform(arrow_map, _meeting_tokens, "token bigint, rep bigint")
    links = staged(spark, verified(_star_pairs(tokens), sets, num, den), "near-links")
    comps = components(spark, links)

    for last in (False, True):
        rest = _between_components(spark, sets, comps, bucket_keys, num, den)
        if rest.isEmpty():
            return comps
        held = staged(spark, rest.transform(arrow_map, _held_tokens(num, den), HELD), "near-held")
        if not last:  # one class of every component against the token's smallest
            pairs = _star_pairs(held.groupBy("token", "comp").agg(F.min("rep").alias("rep")).select("token", "rep"))
        else:  # all pairs between components that may link
            pairs = _pairs_between(held, num, den)
        more = staged(spark, verified(pairs, rest, num, den), "near-links")
        unstage(spark, held)
        unstage(spark, rest)
        if not more.isEmpty():
            links = links.unionByName(more)
            comps = components(spark, links)
    return comps


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    similarity: tuple[int, int] = (3, 4),
    bucket_keys: int = 2_000_000,
) -> DataFrame:
    """``id, n_shingles, component_id`` for every row of ``docs``; ids are integers.

    ``bucket_keys`` bounds the n-grams one task holds: those of a block, and on average
    those of a hash range."""
    num, den = similarity
    spark = docs.sparkSession
    texts = text_input(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    blocks = staged(spark, texts.transform(arrow_map, _text_blocks(bucket_keys, pa.int64()), TEXT_BLOCK), "near-blocks")
    buckets = _buckets(blocks, "n_words", bucket_keys)
    found = blocks.select("block", "ids", "cls", "sigs").transform(arrow_map, _members, "id bigint, sig binary, block bigint, pos int")
    members = staged(spark, found, "near-members")

    # each class is named by its smallest id, and one block stands for it
    first = F.struct(F.col("id").isNull(), "id", "block", "pos")
    named = members.where("sig is not null").groupBy("sig").agg(F.min(first).alias("own"))
    owned = named.select(
        "own.block", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("codes"), "own.pos", F.col("own.id").alias("rep")
    )
    none = [F.lit(None).cast("int").alias("pos"), F.lit(None).cast("long").alias("rep")]
    told = answers(blocks.select("block", "lens", "words", "places"), _text_sets(n), buckets).select("*", *none)
    sent = blocks.select("block", "sigs", "lens", "words", "places").groupBy("block")
    classes = staged(
        spark,
        sent.cogroup(told.unionByName(owned).groupBy("block")).applyInArrow(_class_sets(n, buckets, num, den), CLASS_SETS),
        "near-classes",
    )
    unstage(spark, blocks)
    sets = classes.where("rep is not null and keys is not null").select("rep", "n", "keys")
    comps = linked_components(spark, sets, num, den, bucket_keys)
    of_class = classes.select("sig", "rep", "n").join(comps, classes["rep"] == comps["node"], "left").select(
        "sig", F.col("n").cast("long").alias("n_shingles"), F.coalesce("comp", "rep").alias("component_id")
    )
    return members.join(of_class, "sig", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose id names their component, all columns as they are; rows
    that repeat such an id are reduced to one.  Rows with a null id stay."""
    found = near_duplicates(docs, id_col, text_col, **settings)
    best = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col)).distinct()
    kept = docs.where(F.col(id_col).isNotNull()).join(best, id_col, "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
