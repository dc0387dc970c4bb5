"""Language identification by multilingual mixture inference (operator 8).

Training counts byte trigrams of the labelled texts, hashed to ``BUCKETS`` values, per
language.  A document is taken as a mixture of languages: expectation maximisation
over its trigrams gives each language's proportion, and the set of languages is
grown from the best single one as long as the log likelihood rises by more than a
penalty that grows with the logarithm of the document's size.  The language with the
largest proportion is the prediction.

Results for edge cases: null texts and texts without a letter are ``und`` with score 0;
so is every text if no labelled text with letters was learned from; a null id counts as
an empty one for the split; repeated rows are learned from and predicted each; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from sluice.llm.common import arrow_map, id_field, staged
from sluice.llm.interpolation_lm import remainder

BUCKETS = 1 << 15
UNDETERMINED = "und"
PENALTY = 6.0  # log likelihood per natural logarithm of the number of trigrams
_SPACE = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)], np.uint8)


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text; all but letters counts as one blank."""
    raw = _SPACE[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    blank = raw == 0x20
    raw = raw[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    if len(raw) < 3:
        return np.empty(0, np.uint32)
    r = raw.astype(np.uint32)
    code = (r[:-2] << np.uint32(16)) | (r[1:-1] << np.uint32(8)) | r[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n): one task's counts, summed before they are sent."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if has_letter(text):
                if lang not in counts:
                    counts[lang] = np.zeros(BUCKETS, np.int64)
                counts[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], names=["lang", "bucket", "n"]
        )


class LanguageModel:
    def __init__(self, langs: list[str], counts: np.ndarray, smoothing: float = 0.5):
        self.langs = langs
        smooth = counts + smoothing
        self.like = smooth / smooth.sum(axis=1, keepdims=True)
        self.log = np.log(self.like)

    def proportions(self, like: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, float]:
        """Mixture weights of the rows of ``like`` by expectation maximisation, and the
        log likelihood."""
        share, total = start, n.sum()
        for _ in range(rounds):
            mix = share @ like
            new = share * (like @ (n / mix)) / total
            done = np.abs(new - share).max() < 1e-3
            share = new
            if done:
                break
        return share, float(n @ np.log(share @ like))

    def mixture(self, text: str) -> list[tuple[str, float]]:
        """The chosen languages with their proportions, largest first."""
        if not self.langs or not has_letter(text):
            return []
        at, n = np.unique(trigrams(text), return_counts=True)
        if not len(at):
            return [(self.langs[0], 1.0 / len(self.langs))]
        n = n.astype(float)
        like = self.like[:, at]
        single = self.log[:, at] @ n
        chosen = [int(np.argmax(single))]
        share, best = np.ones(1), float(single[chosen[0]])
        penalty = PENALTY * np.log(n.sum() + 1)
        while len(chosen) < len(self.langs):
            # where the likelihood does not rise towards a language, it is not in the mixture
            slope = like @ (n / (share @ like[chosen])) - n.sum()
            rest = [i for i in range(len(self.langs)) if i not in chosen and slope[i] > 0]
            found = None
            for i in rest:
                start = np.append(share * 0.8, 0.2)
                got = self.proportions(like[[*chosen, i]], n, start)
                if got[1] - best > penalty and (found is None or got[1] > found[1]):
                    found = (*got, i)
            if found is None:
                break
            share, best = found[0], found[1]
            chosen.append(found[2])
        # how far the best single language leads, softened as trigrams overlap
        lead = np.exp((single - single.max()) / 3)
        trust = float(lead[chosen].sum() / lead.sum()) if len(chosen) == 1 else 1.0
        order = np.argsort(-share, kind="stable")
        return [(self.langs[chosen[i]], float(share[i]) * trust) for i in order]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_languages: int = 500) -> LanguageModel:
    """Counts over all given rows with text and language; more than ``most_languages``
    languages are an error, which bounds what the driver holds."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    counted = rows.transform(arrow_map, _count, "lang string, bucket int, n bigint")
    sums = staged(docs.sparkSession, counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "lang-counts")
    langs = [r[0] for r in sums.select("lang").distinct().limit(most_languages + 1).collect()]
    if len(langs) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    table = sums.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((len(langs), BUCKETS))
    which = {lang: i for i, lang in enumerate(langs)}
    counts[[which[x] for x in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return LanguageModel(langs, counts)


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, lang_pred, score, languages`` for every row: ``languages`` lists the
    mixture as (lang, proportion)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    part = StructType([StructField("lang", StringType()), StructField("proportion", DoubleType())])
    schema = StructType([
        id_field(docs, id_col), StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("languages", ArrayType(part)),
    ])
    kind = pa.list_(pa.struct([("lang", pa.string()), ("proportion", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            got = [m.mixture(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"),
                pa.array([g[0][0] if g else UNDETERMINED for g in got], pa.string()),
                pa.array([min(1.0, max(0.0, g[0][1])) if g else 0.0 for g in got], pa.float64()),
                pa.array([[{"lang": a, "proportion": p} for a, p in g] for g in got], kind),
            ], names=[id_col, "lang_pred", "score", "languages"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(arrow_map, run, schema)


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1
) -> DataFrame:
    """``id, held_out, lang_pred, score`` for every row, learned from the rows whose
    id's crc32 modulo ``folds`` is not ``held``."""
    fold = remainder(F.col(id_col), folds)
    model = learn(docs.where(fold != held), text_col, lang_col)
    found = predict(docs, model, id_col, text_col)
    return found.select(id_col, (fold == held).cast(BooleanType()).alias("held_out"), "lang_pred", "score")
