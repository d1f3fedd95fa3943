"""Gold dimensions and facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import date_key

# The published column order of each Gold table.
DIM_COLUMNS = {
    "dim_user": ("user_id", "full_name", "email", "phone", "kyc_verified", "created_at"),
    "dim_account": ("account_id", "user_id", "account_type", "currency", "created_at"),
    "dim_merchant": ("merchant_id", "merchant_name", "category"),
    "dim_device": ("device_id", "user_id", "device_type", "os", "first_seen_at"),
}
FACT_COLUMNS = {
    "fact_transactions": (
        "transaction_id", "user_id", "account_id", "merchant_id", "device_id",
        "counterparty_account_id", "date_key", "type", "status", "channel", "currency",
        "amount", "old_balance", "new_balance", "timestamp", "ingested_at", "event_date"),
    "fact_login_events": (
        "login_id", "user_id", "device_id", "date_key", "is_success", "login_ts", "event_date"),
    "fact_balance_snapshot": ("account_id", "date_key", "snapshot_date", "closing_balance"),
}


def dim_user(users: DataFrame) -> DataFrame:
    return users.select(*DIM_COLUMNS["dim_user"])


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select(*DIM_COLUMNS["dim_account"])


def dim_merchant(merchants: DataFrame) -> DataFrame:
    return merchants.select(*DIM_COLUMNS["dim_merchant"])


def dim_device(devices: DataFrame) -> DataFrame:
    return devices.select(*DIM_COLUMNS["dim_device"])


def observed_dates(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct calendar dates of several (frame, column) sources, NULLs left out.

    Each source is reduced to one column, and `distinct` is partially aggregated before its
    shuffle, so what crosses the network is a few dates per task whatever the size of the facts.
    """
    dates = (df.select(F.to_date(column).alias("calendar_date")) for df, column in sources)
    every = reduce(DataFrame.unionByName, dates)
    return every.filter(F.col("calendar_date").isNotNull()).distinct()


def dim_date(transactions: DataFrame, logins: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row per date that occurs in some fact; gaps are not filled."""
    day = F.col("calendar_date")
    dates = observed_dates(
        [(transactions, "timestamp"), (logins, "login_ts"), (snapshots, "snapshot_date")])
    return dates.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def _dated(df: DataFrame, column: str, day: Column, table: str) -> DataFrame:
    return (
        df.withColumn(column, day)
        .withColumn("date_key", date_key(F.col(column)))
        .select(*FACT_COLUMNS[table])
    )


def fact_transactions(transactions: DataFrame) -> DataFrame:
    return _dated(transactions, "event_date", F.to_date("timestamp"), "fact_transactions")


def fact_login_events(logins: DataFrame) -> DataFrame:
    return _dated(logins, "event_date", F.to_date("login_ts"), "fact_login_events")


def fact_balance_snapshot(snapshots: DataFrame) -> DataFrame:
    return _dated(snapshots, "snapshot_date", F.to_date("snapshot_date"), "fact_balance_snapshot")
