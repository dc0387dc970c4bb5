"""The operators' registered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.bitplanes import cluster_vectors
from sluice.llm.decontaminate import contamination
from sluice.llm.interpolation_lm import interpolated_scores
from sluice.llm.jaccard_join import near_duplicates
from sluice.llm.merge_rounds import piece_codec
from sluice.llm.mincut_html import extract_main_text
from sluice.llm.mixture_langid import languages
from sluice.llm.oracle import ORACLE_SQL
from sluice.llm.prefix_bpe import bpe_codec
from sluice.llm.quality_cascade import quality
from sluice.llm.surrogates import private_counts, require_distinct
from sluice.llm.token_counts import token_counts
from sluice.llm.warc import archive_round_trip
from sluice.llm.whitening import whitened

WINDOW = 13  # words of a benchmark window
TOKEN_LIMIT = 2048
SURROGATE_KEY = b"key of the registered queries"  # in production from a secret store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> tuple[str, str]:
    """The ranks and the pattern of the registered byte-level tokenizer."""
    import public_tokenizers

    return tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_warc(spark, d):
    return archive_round_trip(table(spark, d, "pages"))


def op2_surrogates(spark, d):
    docs = table(spark, d, "documents")
    require_distinct(docs, SURROGATE_KEY)
    return private_counts(docs, SURROGATE_KEY)


def op3_interpolation_lm(spark, d):
    return interpolated_scores(table(spark, d, "documents"))


def op4_jaccard_join(spark, d):
    return near_duplicates(table(spark, d, "documents"))


def op5_prefix_bpe(spark, d):
    return bpe_codec(table(spark, d, "documents"), *byte_bpe())


def op6_decontamination(spark, d):
    return contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), window=WINDOW)


def op7_mincut_html(spark, d):
    return extract_main_text(table(spark, d, "pages"))


def op8_mixture_langid(spark, d):
    return languages(table(spark, d, "documents"))


def op9_token_counts(spark, d):
    return token_counts(table(spark, d, "documents"), tokenizer_file("word_bpe_49k.json"), limit=TOKEN_LIMIT)


def op10_quality_cascade(spark, d):
    # which of several rules rejects first depends on the measured order, the verdict does not
    return quality(table(spark, d, "documents")).drop("rejected_by")


def op11_bitplane_clusters(spark, d):
    return cluster_vectors(table(spark, d, "embeddings"))


def op12_qdwh_whitening(spark, d):
    return whitened(table(spark, d, "embeddings"))


def op13_merge_rounds(spark, d):
    return piece_codec(table(spark, d, "documents"), tokenizer_file("piece_bpe_32k.model"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_surrogates": op2_surrogates,
    "op3_interpolation_lm": op3_interpolation_lm,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_prefix_bpe": op5_prefix_bpe,
    "op6_decontamination": op6_decontamination,
    "op7_mincut_html": op7_mincut_html,
    "op8_mixture_langid": op8_mixture_langid,
    "op9_token_counts": op9_token_counts,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_bitplane_clusters": op11_bitplane_clusters,
    "op12_qdwh_whitening": op12_qdwh_whitening,
    "op13_merge_rounds": op13_merge_rounds,
}
