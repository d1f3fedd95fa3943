"""Bronze to Silver cleaning rules per table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import columns as X
from ledgerlake.operators.dedup import keep_any, keep_latest

TRANSACTION_KINDS = {
    "timestamp": "timestamp", "ingested_at": "timestamp",
    "amount": "double", "old_balance": "double", "new_balance": "double",
}


def clean_users(df: DataFrame) -> DataFrame:
    kept = keep_any(df.filter(X.present("user_id")), ["user_id"])
    return X.cast_columns(kept, {"created_at": "timestamp"})


def clean_accounts(df: DataFrame) -> DataFrame:
    kept = keep_any(df.filter(X.present("account_id", "user_id")), ["account_id"])
    return X.cast_columns(kept, {"created_at": "timestamp"})


def clean_merchants(df: DataFrame) -> DataFrame:
    return keep_any(df.filter(X.present("merchant_id")), ["merchant_id"])


def clean_devices(df: DataFrame) -> DataFrame:
    kept = keep_any(df.filter(X.present("device_id", "user_id")), ["device_id"])
    return X.cast_columns(kept, {"first_seen_at": "timestamp"})


def typed_transactions(df: DataFrame, strict: bool = True) -> DataFrame:
    """Schema fix-up, casts and channel normalization, before any row is dropped."""
    df = X.ensure_column(df, "channel", "string")
    df = X.cast_columns(df, TRANSACTION_KINDS, strict)
    return df.withColumn("channel", X.normalize_channel(F.col("channel")))


def clean_transactions(df: DataFrame, strict: bool = True) -> DataFrame:
    """Valid transactions, one per id, with `event_date`.

    Filters come before the dedup on purpose: if the newest copy is invalid, an older valid copy
    survives. It also means invalid rows are never shuffled.
    """
    valid = typed_transactions(df, strict).filter(X.structurally_valid() & X.in_domain())
    latest = keep_latest(valid, ["transaction_id"], ["ingested_at"])
    return latest.withColumn("event_date", F.to_date("timestamp"))


def quarantine_transactions(df: DataFrame) -> DataFrame:
    """Rows that the lenient mode cannot type; the strict mode fails on them instead."""
    return df.filter(X.uncastable(TRANSACTION_KINDS))


def clean_balance_snapshots(df: DataFrame) -> DataFrame:
    typed = X.cast_columns(df, {"snapshot_date": "date", "closing_balance": "double"})
    valid = typed.filter(X.present("account_id", "snapshot_date") & (F.col("closing_balance") >= 0))
    return keep_any(valid, ["account_id", "snapshot_date"])


def clean_login_events(df: DataFrame) -> DataFrame:
    typed = X.cast_columns(df, {"login_ts": "timestamp"})
    valid = typed.filter(X.present("login_id", "user_id", "device_id", "login_ts"))
    return keep_any(valid, ["login_id"]).withColumn("login_date", F.to_date("login_ts"))


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "users": clean_users,
    "accounts": clean_accounts,
    "merchants": clean_merchants,
    "devices": clean_devices,
    "transactions": clean_transactions,
    "balance_snapshots": clean_balance_snapshots,
    "login_events": clean_login_events,
}
