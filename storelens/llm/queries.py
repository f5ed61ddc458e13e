"""The registered queries of the subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import (decontamination, html, licenses, mixing, prefixtrie, quality, repair, sharding, simhash, sql,
               tokencounts, tokenfiles, topk, toxicity)
from .common import read_table, whole_text

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return run(spark, sf_dir)
        QUERIES[run.__name__] = prepared
        if oracle:
            SQL[run.__name__] = oracle
        return run
    return register


@query(sql.TOP_K)
def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


@query(sql.MIXING)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


@query(sql.license_scan())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


@query()
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return quality.score(documents, *quality.learn(documents, read_table(spark, sf_dir, "labels")))


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"),
                                        read_table(spark, sf_dir, "benchmark"))


@query()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), mixing.word_count(whole_text()))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.learn(documents, read_table(spark, sf_dir, "labels")))


@query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_digest(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_conversations(read_table(spark, sf_dir, "conversations"))


@query()
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(read_table(spark, sf_dir, "conversations")))


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(read_table(spark, sf_dir, "documents"), PIECES)
