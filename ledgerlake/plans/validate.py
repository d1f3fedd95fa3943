"""Validation of written layers: report, then pass or raise."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from ledgerlake import config
from ledgerlake.operators.quality import gate, gold_report, silver_report
from ledgerlake.sources.tables import zone

log = logging.getLogger(__name__)


def _pass(report) -> list:
    rows = gate(report)
    for row in rows:
        log.info("PASS | %s | actual=%s | expected=%s", row.rule_name, row.actual_value,
                 row.expected)
    return rows


def validate_silver(spark: SparkSession, lake: config.Lakehouse) -> list:
    return _pass(silver_report(zone(spark, lake, "silver", config.TABLES)))


def validate_gold(spark: SparkSession, lake: config.Lakehouse) -> list:
    return _pass(gold_report(zone(spark, lake, "silver", config.TABLES),
                             zone(spark, lake, "gold", config.GOLD_PARTITIONS)))
