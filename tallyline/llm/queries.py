"""The queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import (
    bpe, decontamination, divergence, fingerprints, html_text, jaccard_join, line_dedup, pii, quality, ranked_search, suffix_dedup,
    token_counts, toxicity,
)
from tallyline.llm.common import read
from tallyline.llm.oracles import ORACLES

WORD_BPE = tokenizer_path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(read(spark, sf_dir, "documents")).drop("row_key")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), WORD_BPE)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), WORD_BPE)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_common_lines(read(spark, sf_dir, "documents")).drop("kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_bpe": op4_bpe,
        "op5_token_counts": op5_token_counts,
        "op6_toxicity": op6_toxicity,
        "op7_pii": op7_pii,
        "op8_fingerprints": op8_fingerprints,
        "op9_html_text": op9_html_text,
        "op10_quality": op10_quality,
        "op11_ranked_search": op11_ranked_search,
        "op12_divergence": op12_divergence,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
