"""Merchant analytics and the merchant-skew workload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ZEROES = {
    "transaction_count": 0, "total_amount": 0.0, "avg_amount": 0.0,
    "success_count": 0, "failed_count": 0,
}


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
    ]


def _every_merchant(merchants: DataFrame, metrics: DataFrame, zeroes: dict) -> DataFrame:
    attrs = merchants.select("merchant_id", "merchant_name", "category")
    return (
        attrs.join(metrics, "merchant_id", "left").fillna(zeroes)
        .select(*attrs.columns, *zeroes)
    )


def merchant_performance(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """Per merchant: volume, value, outcomes and distinct users; idle merchants get zeros.

    The distinct count makes Spark shuffle by (merchant, user), which spreads a hot merchant.
    """
    metrics = fact.filter("merchant_id IS NOT NULL").groupBy("merchant_id").agg(
        *_measures(), F.count_distinct("user_id").alias("distinct_users"))
    return _every_merchant(merchants, metrics, {**_ZEROES, "distinct_users": 0})


def merchant_workload(
    transactions: DataFrame, merchants: DataFrame, salts: int = 1,
) -> DataFrame:
    """The same without the distinct count: the query the skew benchmark times.

    Aggregating before the join already shrinks a hot merchant to one row per map task. With
    `salts` > 1 the rows are aggregated per (merchant, salt) first, for sessions that cannot
    combine on the map side well; the result is the same up to floating-point order.
    """
    paid = transactions.filter("merchant_id IS NOT NULL")
    if salts == 1:
        metrics = paid.groupBy("merchant_id").agg(*_measures())
    else:
        # The salt hangs on the row's own id, so a retried task deals its rows out the same way.
        salt = F.pmod(F.xxhash64("transaction_id"), F.lit(salts))
        parts = paid.groupBy("merchant_id", salt.alias("_salt")).agg(
            *_measures(), F.count("amount").alias("_valued"))
        metrics = parts.groupBy("merchant_id").agg(
            F.sum("transaction_count").alias("transaction_count"),
            F.sum("total_amount").alias("total_amount"),
            (F.sum("total_amount") / F.sum("_valued")).alias("avg_amount"),
            F.sum("success_count").alias("success_count"),
            F.sum("failed_count").alias("failed_count"),
        )
    return _every_merchant(merchants, metrics, _ZEROES)


def merchant_workload_join_first(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """The workload with the fact-sized join up front, where a skewed key really bites.

    Kept to measure AQE's skew handling against; the aggregate-first form is the one to use.
    """
    paid = transactions.filter("merchant_id IS NOT NULL").select(
        "merchant_id", "amount", "status", F.lit(1).alias("_paid"))
    joined = merchants.select("merchant_id", "merchant_name", "category").join(
        paid, "merchant_id", "left")
    return joined.groupBy("merchant_id", "merchant_name", "category").agg(
        F.count("_paid").alias("transaction_count"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_amount"),
        F.coalesce(F.avg("amount"), F.lit(0.0)).alias("avg_amount"),
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
    )


def control_totals(workload: DataFrame) -> DataFrame:
    """One row of sums by which two runs of the workload can be compared."""
    return workload.agg(
        F.count(F.lit(1)).alias("result_rows"),
        F.sum("transaction_count").alias("transactions"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("success_count").alias("success"),
        F.sum("failed_count").alias("failed"),
    )
