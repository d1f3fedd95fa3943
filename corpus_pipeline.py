"""From raw documents to shards of training sequences, stage by stage.

Each stage gets what the stage before it kept, as stored Parquet, and returns a frame; all but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, host_quality, mixing, near_dups, training_order
from ledgerlake.sources.supplied import raw
from ledgerlake.sources.workspace import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that their host's verdict rejects, go."""
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return near_dups.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.keep_clean(docs, raw(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last one of a source is cut to fit."""
    return mixing.mixed(docs)


def training_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in training order, as shards in the shared folder; returns where each sequence is."""
    return training_order.write_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("training_shards", training_shards),
]

#: SQL has no tokenizer for the last stage; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
