"""Measurements: the merchant workload with AQE off and on, exact against approximate distinct."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from ledgerlake import config
from ledgerlake.operators import merchants, profile
from ledgerlake.streaming.jobs import settings

MODES = {"baseline": "false", "optimized": "true"}


def adaptive(spark: SparkSession, mode: str):
    """Session options of a mode: `baseline` runs without AQE, `optimized` with all of it."""
    on = MODES[mode]
    return settings(spark, spark__sql__adaptive__enabled=on,
                    spark__sql__adaptive__skewJoin__enabled=on,
                    spark__sql__adaptive__coalescePartitions__enabled=on)


def timed(run: Callable[[], Row]) -> tuple[Row, float]:
    started = time.perf_counter()
    row = run()
    return row, time.perf_counter() - started


def merchant_benchmark(
    spark: SparkSession, transactions: DataFrame, merchant_table: DataFrame, mode: str,
    variant: Callable[..., DataFrame] = merchants.merchant_workload, explain: bool = False,
) -> dict:
    """Run one variant of the workload in one mode; totals let modes and variants be compared."""
    with adaptive(spark, mode):
        workload = variant(transactions, merchant_table)
        if explain:
            workload.explain("formatted")
        totals, seconds = timed(lambda: merchants.control_totals(workload).first())
        if explain:
            workload.explain("formatted")
    return {"mode": mode, "seconds": seconds, **totals.asDict()}


def distinct_benchmark(
    spark: SparkSession, transactions: DataFrame, key: str = "transaction_id",
    rsd: float = config.DEFAULT_RSD,
) -> dict:
    """Exact and approximate distinct counts, both without AQE, with times and errors."""
    with adaptive(spark, "baseline"):
        exact, exact_s = timed(lambda: profile.distinct_exact(transactions, key).first())
        approx, approx_s = timed(lambda: profile.distinct_approx(transactions, key, rsd).first())
    off = abs(approx[0] - exact[0])
    return {
        "exact_count": exact[0], "approx_count": approx[0], "absolute_error": off,
        "relative_error_pct": off / exact[0] * 100 if exact[0] else 0.0,
        "exact_seconds": exact_s, "approx_seconds": approx_s,
        "exact_over_approx": exact_s / approx_s if approx_s > 0 else None,
    }
