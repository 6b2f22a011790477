"""The corpus pipeline: documents in, encoded training texts out.

Each stage applies one operator of ``tallyline.llm`` to everything its predecessor kept, and its decisions
take effect: toxic documents go, one document of each group of near copies stays, documents that hold
a benchmark item go, personal data is replaced in the texts, and what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import bpe, decontamination, jaccard_join, pii, toxicity
from tallyline.llm.common import read, saved
from tallyline.llm.queries import WORD_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below a half, as learned from the labels of ``documents``."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return jaccard_join.deduplicated(docs)


def not_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, hashes of the ids and of the decoded text, and the ids themselves."""
    return bpe.encode(docs, WORD_BPE, keep_ids=True).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", not_benchmark),
    ("personal_data", without_personal_data),
    ("encoding", encoded),
]

#: SQL has no form for most stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
