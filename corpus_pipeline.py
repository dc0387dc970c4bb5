"""A training corpus from ``documents``: quality rules, one document of each group of
near duplicates, benchmark passages cut, personal data replaced, token ids.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet to
the shared scratch folder and read again as the next one's documents, so that a lost
executor costs one stage's tasks at most.  All stages but the last return the columns
of ``documents``; texts that a stage changes get their new ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import staged
from sluice.llm.decontaminate import remove_contamination
from sluice.llm.jaccard_join import keep_one_of_each
from sluice.llm.prefix_bpe import bpe_codec
from sluice.llm.quality_cascade import keep_good
from sluice.llm.queries import SURROGATE_KEY, WINDOW, byte_bpe, table
from sluice.llm.surrogates import replace_private, require_distinct


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut from contaminated documents."""
    return remove_contamination(docs, table(spark, sf_dir, "benchmark"), window=WINDOW)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates, if the collision check finds none of them shared or split."""
    require_distinct(docs, SURROGATE_KEY)
    return replace_private(docs, SURROGATE_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to.  The
    memo is small, as the workers still hold what the stages before left them."""
    outputs = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return bpe_codec(docs, *byte_bpe(), outputs=outputs, memo_bytes=48 << 20)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("tokens", tokens),
]

# Prefix tables and keyed surrogates have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
