"""Silver to Gold."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerlake import config
from ledgerlake.operators import model
from ledgerlake.operators.enrich import enrich_transactions
from ledgerlake.operators.features import user_features_90d
from ledgerlake.operators.merchants import merchant_performance
from ledgerlake.sources.tables import read_table, write_table, zone

log = logging.getLogger(__name__)


def build_gold(
    spark: SparkSession, lake: config.Lakehouse, silver: Mapping[str, DataFrame],
    partitions: Mapping[str, tuple[str, ...]] = config.GOLD_PARTITIONS,
) -> dict[str, DataFrame]:
    """Write every Gold table and return them as read back.

    Dimensions and facts are written first; the wide table, the features and the analytics read
    those files instead of running the Silver plans again.
    """
    gold: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame) -> None:
        started = time.perf_counter()
        write_table(df, lake.path("gold", name), lake.fmt, partitions.get(name, ()))
        gold[name] = read_table(spark, lake, "gold", name)
        log.info("%s written in %.2f s", name, time.perf_counter() - started)

    publish("dim_user", model.dim_user(silver["users"]))
    publish("dim_account", model.dim_account(silver["accounts"]))
    publish("dim_merchant", model.dim_merchant(silver["merchants"]))
    publish("dim_device", model.dim_device(silver["devices"]))
    publish("fact_transactions", model.fact_transactions(silver["transactions"]))
    publish("fact_login_events", model.fact_login_events(silver["login_events"]))
    publish("fact_balance_snapshot", model.fact_balance_snapshot(silver["balance_snapshots"]))
    fact = gold["fact_transactions"]
    publish("dim_date", model.dim_date(
        fact, gold["fact_login_events"], gold["fact_balance_snapshot"]))
    publish("obt_transaction_enriched", enrich_transactions(
        fact, gold["dim_user"], gold["dim_account"], gold["dim_device"], gold["dim_merchant"],
        gold["dim_date"]))
    publish("feat_user_90d", user_features_90d(fact, gold["dim_user"]))
    publish("opt_merchant_performance", merchant_performance(fact, gold["dim_merchant"]))
    return gold


def run_gold(spark: SparkSession, lake: config.Lakehouse) -> dict[str, DataFrame]:
    return build_gold(spark, lake, zone(spark, lake, "silver", config.TABLES))
