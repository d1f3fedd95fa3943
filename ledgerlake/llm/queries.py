"""The operators as queries over the supplied tables, with the SQL twins that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (brown_lm, conversation_trie, decontaminate, host_quality, kneser_ney,
                            language_id, lexical_search, mixing, near_dups, packing, suffix_dups,
                            training_order, warc)
from ledgerlake.llm.sql import ORACLE  # noqa: F401
from ledgerlake.sources.supplied import raw


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.write_shards(raw(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(raw(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(raw(spark, sf_dir, "pages"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dups.report(raw(spark, sf_dir, "documents"))


def op5_trusted_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = raw(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return kneser_ney.classify(raw(spark, sf_dir, "documents"), trusted)


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(raw(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(raw(spark, sf_dir, "documents")).drop("text_md5")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(raw(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(raw(spark, sf_dir, "documents"), raw(spark, sf_dir, "benchmark"))


def op10_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judge(raw(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(raw(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(raw(spark, sf_dir, "documents"), raw(spark, sf_dir, "benchmark"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.report(raw(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_training_order, op2_near_duplicates, op3_warc, op4_repeated_passages,
    op5_trusted_perplexity, op6_class_lm, op7_source_mixing,
    op8_language_id, op9_decontamination, op10_host_quality,
    op11_packing, op12_lexical_search, op13_conversation_trie,
)}
