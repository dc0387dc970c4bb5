"""Deleted-interpolation bigram model (operator 3).

The probability of a word is a mixture of three estimates: its share among what
followed the word before it, its share among all words (both by maximum
likelihood), and one part in V + 1 for any word.  The weights depend on how often the
word before was seen, by powers of two, and are learned by expectation maximisation
on held-out counts: a tenth of the documents is set aside, the estimates are made
from the rest of the training documents, and the weights that make the documents
set aside most likely are kept.  The final estimates use all training documents.

How it runs: texts become blocks of a bounded number of tokens, written once.  Each
block sends its distinct words and word pairs, as sorted 64-bit hashes with their
counts, to buckets by hash range; a bucket sums what all blocks sent and answers each
block in the order of its request.  A block then knows the counts of all its words
and pairs, wherever in the corpus they are.  Hot words and pairs are one number per
block; nothing that grows with the corpus reaches one task or the driver.

Results for edge cases: null and empty texts, and texts without words, are one end
token; a null id counts as an empty one for the split; repeated rows are scored and
counted each; with no training documents all words are unknown and the model is
uniform; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from sluice.llm.common import arrow_map, mix64, power_of_two, staged, word_hashes

KEPT, HELD, REST = 0, 1, 2  # counts, weights, only scored
U64, U32 = np.dtype("<u8"), np.dtype("<u4")
END = np.array([0x5851F42D4C957F2D], U64)  # the end token, which is also the context of first words
STEPS = 4  # bins of a likelihood ratio per power of two
NEVER = 1 << 20  # bin of pairs that were never seen


# ------------------------------------------------------------------ blocks
class _Block:
    def __init__(self, part: int, limit: int):
        self.part, self.limit = part, limit
        self.clear()

    def clear(self) -> None:
        self.docs: list[int] = []
        self.ids: list = []
        self.sizes: list[int] = []  # stored tokens of each piece, its context included
        self.tokens: list[np.ndarray] = []
        self.total = 0

    def add(self, doc: int, ident, hashes: np.ndarray) -> Iterator[None]:
        """Adds a text in pieces, each led by its context; yields whenever the block is full."""
        at = 0
        whole = np.concatenate([END, hashes, END])
        while at + 1 < len(whole):
            piece = whole[at : at + 1 + max(1, self.limit - self.total)]
            self.docs.append(doc)
            self.ids.append(ident)
            self.sizes.append(len(piece))
            self.tokens.append(piece)
            self.total += len(piece) - 1
            at += len(piece) - 1
            if self.total >= self.limit:
                yield

    def row(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        words, index = np.unique(np.concatenate(self.tokens), return_inverse=True)
        small = np.uint16 if len(words) <= 1 << 16 else np.uint32
        out = pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()),
            pa.array([self.part], pa.int32()),
            pa.array([self.docs], pa.list_(pa.int64())),
            pa.array([self.ids], pa.list_(id_type)),
            pa.array([self.sizes], pa.list_(pa.int32())),
            pa.array([words.tobytes()], pa.binary()),
            pa.array([index.astype(small).tobytes()], pa.binary()),
        ], names=["block", "part", "docs", "ids", "sizes", "words", "index"])
        self.clear()
        return out


def _blocks(limit: int, id_type: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        open_blocks = [_Block(p, limit) for p in (KEPT, HELD, REST)]
        doc = number = 0
        for batch in batches:
            for ident, part, text in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "text"))):
                b = open_blocks[part]
                for _ in b.add(base + doc, ident, word_hashes(text or b"")):
                    yield b.row(base + number, id_type)
                    number += 1
                doc += 1
        for b in open_blocks:
            if b.docs:
                yield b.row(base + number, id_type)
                number += 1

    return run


def _index(row: dict) -> np.ndarray:
    small = np.uint16 if len(row["words"]) // 8 <= 1 << 16 else np.uint32
    return np.frombuffer(row["index"], small).astype(np.int64)


class _Tokens:
    """A block's words, and its distinct words and pairs as sorted keys."""

    def __init__(self, row: dict):
        words = np.frombuffer(row["words"], U64)
        index = _index(row)
        sizes = np.asarray(row["sizes"], np.int64)
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(len(index), bool)
        first[starts] = True
        self.here = np.flatnonzero(~first)  # all but the contexts that lead a piece
        self.piece_at = starts - np.arange(len(starts))  # first of each piece in ``here``
        v, u = index[self.here], index[self.here - 1]
        self.v, self.u = v, u
        self.words = words
        pairs, self.pair = np.unique(u * len(words) + v, return_inverse=True)
        hashed = mix64(mix64(words[pairs // len(words)]) + words[pairs % len(words)])
        order = np.argsort(hashed, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.pair = back[self.pair.reshape(-1)]  # position of each token's pair among the sorted keys
        self.pair_keys = hashed[order]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(self.v, minlength=len(self.words)), np.bincount(self.pair, minlength=len(self.pair_keys))


def _planes(keys: np.ndarray) -> bytes:
    """Sorted keys, byte by byte, so that their leading bytes compress."""
    return np.ascontiguousarray(keys.astype(U64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _keys(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(U64).reshape(-1)


REQUEST = "bucket int, block bigint, part int, wk binary, wc binary, pk binary, pc binary"
REPLY = "block bigint, bucket int, w_all binary, w_kept binary, p_all binary, p_kept binary, distinct bigint"


def _requests(buckets: int):
    bits = buckets.bit_length() - 1

    def pieces(keys: np.ndarray) -> dict[int, slice]:
        """The buckets that sorted keys fall into, and their place there."""
        found, at = {}, 0
        while at < len(keys):
            b = int(keys[at]) >> (64 - bits)
            last = np.uint64(((b + 1) << (64 - bits)) - 1)
            end = int(np.searchsorted(keys, last, "right"))
            found[b] = slice(at, end)
            at = end
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = _Tokens(row)
                wc, pc = (c.astype(U32) for c in t.counts())
                words, pairs = pieces(t.words), pieces(t.pair_keys)
                out = {n.split()[0]: [] for n in REQUEST.split(", ")}
                for b in sorted(words.keys() | pairs.keys()):
                    w, p = words.get(b, slice(0)), pairs.get(b, slice(0))
                    out["bucket"].append(b)
                    out["wk"].append(_planes(t.words[w]))
                    out["wc"].append(wc[w].tobytes())
                    out["pk"].append(_planes(t.pair_keys[p]))
                    out["pc"].append(pc[p].tobytes())
                del t, wc, pc  # before the next block's are made
                m = len(out["bucket"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(out["bucket"], pa.int32()),
                    pa.array([row["block"]] * m, pa.int64()),
                    pa.array([row["part"]] * m, pa.int32()),
                    *(pa.array(out[c], pa.binary()) for c in ("wk", "wc", "pk", "pc")),
                ], names=list(out))

    return run


def _answer(parts: list[int], keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list, list, int]:
    """Per request: counts over all training blocks, and over the kept ones; and the
    number of distinct keys in training."""
    sizes = [len(k) for k in keys]
    every, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    part = np.repeat(parts, sizes)
    distinct, where = np.unique(every, return_inverse=True)
    where = where.reshape(-1)
    kept = np.bincount(where, weights=count * (part == KEPT), minlength=len(distinct)).astype(np.int64)
    total = kept + np.bincount(where, weights=count * (part == HELD), minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum(sizes)
    pieces = [where[e - s : e] for s, e in zip(sizes, ends)]
    return [total[p] for p in pieces], [kept[p] for p in pieces], int((total > 0).sum())


def _small(counts: np.ndarray) -> bytes:
    """Counts as 4 bytes each, 8 where one needs them, byte planes apart; the first
    byte tells which."""
    dtype = U32 if not len(counts) or counts.max() < 1 << 32 else U64
    planes = counts.astype(dtype).view(np.uint8).reshape(-1, dtype.itemsize).T
    return bytes([dtype.itemsize]) + np.ascontiguousarray(planes).tobytes()


def _unsmall(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    return np.ascontiguousarray(raw.T).view(f"<u{data[0]}").reshape(-1).astype(np.int64)


def _replies(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    parts = [r["part"] for r in rows]
    w_all, w_kept, distinct = _answer(parts, [_keys(r["wk"]) for r in rows], [np.frombuffer(r["wc"], U32) for r in rows])
    p_all, p_kept, _ = _answer(parts, [_keys(r["pk"]) for r in rows], [np.frombuffer(r["pc"], U32) for r in rows])
    held = [p == HELD for p in parts]
    none = _small(np.empty(0, np.int64))
    return pa.table({
        "block": pa.array([r["block"] for r in rows], pa.int64()),
        "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
        "w_all": pa.array([_small(x) for x in w_all], pa.binary()),
        "w_kept": pa.array([_small(x) if h else none for x, h in zip(w_kept, held)], pa.binary()),
        "p_all": pa.array([_small(x) for x in p_all], pa.binary()),
        "p_kept": pa.array([_small(x) if h else none for x, h in zip(p_kept, held)], pa.binary()),
        "distinct": pa.array([distinct if i == 0 else 0 for i in range(len(rows))], pa.int64()),
    })


def _join_replies(right: pa.Table, name: str) -> np.ndarray:
    rows = sorted(zip(right.column("bucket").to_pylist(), right.column(name).to_pylist()))
    return np.concatenate([_unsmall(x) for _, x in rows])


# ------------------------------------------------------------------ weights
def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then one bucket per power of two."""
    return np.frexp(count.astype(np.float64))[1]


def _held_bins(n_kept: int, n_words: int):
    """Held-out tokens by context bucket and by the ratios of the three estimates."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"context": [], "pair_bin": [], "word_bin": [], "tokens": []}
        for row in left.to_pylist():
            t = _Tokens(row)
            w, p = _join_replies(right, "w_kept"), _join_replies(right, "p_kept")
            cu, cv, cuv = w[t.u].astype(float), w[t.v].astype(float), p[t.pair].astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                pair = np.where(cuv > 0, np.round(STEPS * np.log2(cuv / cu * n_kept / np.maximum(cv, 1))), NEVER)
                word = np.where(cv > 0, np.round(STEPS * np.log2(np.maximum(cv, 1) / n_kept * (n_words + 1))), NEVER)
            rows = np.stack([context_bucket(cu), pair.astype(np.int64), word.astype(np.int64)])
            bins, counts = np.unique(rows, axis=1, return_counts=True)
            for name, values in zip(out, (*bins, counts)):
                out[name].append(values)
        return pa.table({
            n: pa.array(np.concatenate(v) if v else [], pa.int64()) for n, v in out.items()
        })

    return run


def learn_weights(bins: list[tuple[int, int, int, int]], rounds: int = 60) -> dict[int, tuple[float, float, float]]:
    """Per context bucket the weights of pair, word and uniform estimate by expectation
    maximisation over held-out tokens given as (bucket, pair bin, word bin, tokens)."""
    out: dict[int, tuple[float, float, float]] = {}
    table = np.array(bins, np.int64).reshape(-1, 4)
    for bucket in np.unique(table[:, 0]):
        rows = table[table[:, 0] == bucket]
        never = rows[:, 1:3] == NEVER
        ratio = np.where(never, 0.0, np.exp2(np.where(never, 0, rows[:, 1:3]) / STEPS))
        word = ratio[:, 1]
        pair = ratio[:, 0] * word
        like = np.stack([pair, word, np.ones(len(rows))], axis=1)
        count = rows[:, 3].astype(float)
        weights = np.full(3, 1 / 3)
        if bucket == 0:
            weights = np.array([0.0, 0.5, 0.5])  # nothing is known about such a context
        for _ in range(rounds):
            share = like * weights
            share /= share.sum(axis=1, keepdims=True)
            # half a token for each estimate keeps every word possible
            weights = (share * count[:, None]).sum(axis=0) + 0.5
            if bucket == 0:
                weights[0] = 0.0
            weights /= weights.sum()
        out[int(bucket)] = tuple(float(x) for x in weights)
    return out


def weight_table(learned: dict[int, tuple[float, float, float]], size: int = 66) -> np.ndarray:
    """Weights for every bucket: buckets without held-out tokens take those of the
    nearest learned one."""
    if not learned:
        return np.array([(0.0, 0.5, 0.5)] * size)
    known = sorted(learned)
    rows = [learned[min(known, key=lambda k: (abs(k - b), k))] for b in range(size)]
    rows[0] = learned.get(0, (0.0, 0.5, 0.5))
    return np.array(rows)


# ------------------------------------------------------------------ scores
def _scores(n_train: int, n_words: int, weights: np.ndarray, id_type: pa.DataType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("doc", "id", "n_tokens", "n_known", "base_score", "score")}
        for row in left.to_pylist():
            t = _Tokens(row)
            w, p = _join_replies(right, "w_all"), _join_replies(right, "p_all")
            cu, cv, cuv = w[t.u], w[t.v], p[t.pair]
            lam = weights[context_bucket(cu)]
            like = lam[:, 2] / (n_words + 1)
            if n_train:
                like = like + lam[:, 1] * cv / n_train + lam[:, 0] * cuv / np.maximum(cu, 1)
            base = np.log10((cv + 0.1) / (n_train + 0.1 * (n_words + 1)))
            out["doc"] += row["docs"]
            out["id"] += row["ids"]
            out["n_tokens"].append(np.diff(np.append(t.piece_at, len(t.v))))
            out["n_known"].append(np.add.reduceat((cv > 0).astype(np.int64), t.piece_at))
            out["base_score"].append(np.add.reduceat(base, t.piece_at))
            out["score"].append(np.add.reduceat(np.log10(like), t.piece_at))
        return pa.table({
            "doc": pa.array(out["doc"], pa.int64()),
            "id": pa.array(out["id"], id_type),
            **{n: pa.array(np.concatenate(out[n]) if out[n] else [], pa.int64()) for n in ("n_tokens", "n_known")},
            **{n: pa.array(np.concatenate(out[n]) if out[n] else [], pa.float64()) for n in ("base_score", "score")},
        })

    return run


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def interpolated_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    block_tokens: int = 1_500_000,
    bucket_keys: int = 1_500_000,
) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Documents whose id's crc32 is 0 modulo ``folds`` are held out altogether; those with
    remainder ``folds - 1`` set the weights; ``block_tokens`` and ``bucket_keys`` bound
    what a task holds."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)
    fold = remainder(F.col(id_col), folds)
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.when(fold == 0, REST).when(fold == folds - 1, HELD).otherwise(KEPT).cast("int").alias("part"),
        F.col(text_col).cast("binary").alias("text"),
    )
    block_schema = StructType([
        StructField("block", LongType()), StructField("part", IntegerType()),
        StructField("docs", ArrayType(LongType())), StructField("ids", ArrayType(id_type)),
        StructField("sizes", ArrayType(IntegerType())), StructField("words", BinaryType()),
        StructField("index", BinaryType()),
    ])
    blocks = staged(spark, texts.transform(arrow_map, _blocks(block_tokens, arrow_id), block_schema), "lm-blocks")
    tokens = dict(
        blocks.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x - 1))).collect()
    )
    n_kept, n_train = tokens.get(KEPT, 0), tokens.get(KEPT, 0) + tokens.get(HELD, 0)
    buckets = power_of_two(max(1, sum(tokens.values()) // bucket_keys + 1))
    asked = blocks.transform(arrow_map, _requests(buckets), REQUEST)
    replies = staged(spark, asked.groupBy("bucket").applyInArrow(_replies, REPLY), "lm-replies")
    n_words = replies.agg(F.sum("distinct")).first()[0] or 0

    # a block's part is told by its number, so that only held-out replies are read again
    held_blocks = blocks.where(F.col("part") == HELD)
    held_replies = replies.join(held_blocks.select("block"), "block", "left_semi")
    bins = held_blocks.groupBy("block").cogroup(held_replies.groupBy("block")).applyInArrow(
        _held_bins(max(n_kept, 1), n_words), "context bigint, pair_bin bigint, word_bin bigint, tokens bigint"
    )
    # at most 66 contexts and a bounded range of ratios: a small table however large the corpus
    summed = bins.groupBy("context", "pair_bin", "word_bin").agg(F.sum("tokens")).collect()
    weights = weight_table(learn_weights([tuple(r) for r in summed]))

    score_schema = StructType([
        StructField("doc", LongType()), StructField("id", id_type),
        *(StructField(n, LongType()) for n in ("n_tokens", "n_known")),
    ]).add("base_score", "double").add("score", "double")
    pieces = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _scores(n_train, n_words, weights, arrow_id), score_schema
    )
    whole = pieces.groupBy("doc").agg(
        F.first("id").alias("id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score"))
    )
    return whole.select(
        F.col("id").alias(id_col),
        (remainder(F.col("id"), folds) == 0).alias("held_out"),
        "n_tokens", "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
