"""The corpus pipeline: documents to token files in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import decontamination, mixing, queries, simhash, tokenfiles, toxicity
from storelens.llm.common import discard, read_table, stored
from storelens.session import prepare


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity score, learned from the labels, doesn't reject."""
    prepare(spark)
    return toxicity.clean(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: by SimHash, or at a five-word Jaccard similarity of
    4/5 or more."""
    prepare(spark)
    return simhash.one_of_each(docs, by_overlap=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item stands."""
    prepare(spark)
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and their digest."""
    prepare(spark)
    return tokenfiles.token_digest(docs, queries.TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
    ("token files", tokens),
]

# SQL has neither these tokens nor learned weights; tests/llm holds a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
            # The stage is stored, so nothing reads the one before it any more; the tables are never deleted.
            if before is not None:
                discard(before)
            before = docs
    return docs
