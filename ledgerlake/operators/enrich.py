"""The denormalized transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import left_lookup
from ledgerlake.sources.workspace import written

# Attributes taken from each dimension (source -> published name).
ATTRIBUTES = {
    "user_id": {"kyc_verified": "kyc_verified", "created_at": "user_created_at"},
    "account_id": {"account_type": "account_type", "currency": "account_currency",
                   "created_at": "account_created_at"},
    "device_id": {"device_type": "device_type", "os": "os", "first_seen_at": "first_seen_at"},
    "merchant_id": {"merchant_name": "merchant_name", "category": "merchant_category"},
    "date_key": {"day_of_week": "day_of_week", "month": "month", "quarter": "quarter",
                 "year": "year", "is_weekend": "is_weekend"},
}
#: A calendar of a century has fewer days. A larger date table is joined by a shuffle.
CALENDAR_ROWS = 40_000
#: Merchants that are sent to all tasks, of about a hundred bytes.
MERCHANT_ROWS = 500_000
#: Keys of large dimensions, looked up together.
OWNERS = ("user_id", "account_id", "device_id")
MEASURES = ("type", "status", "channel", "currency", "amount", "old_balance", "new_balance",
            "counterparty_account_id", "timestamp", "ingested_at", "event_date")


def enrich_transactions(
    fact: DataFrame, users: DataFrame, accounts: DataFrame, devices: DataFrame,
    merchants: DataFrame, dates: DataFrame,
) -> DataFrame:
    """Every fact row once, with the attributes of five dimensions where they exist.

    Dimension keys must be unique (the Gold rules check it), or fact rows would multiply. The
    merchant key is NULL for everything but payments, hence the spread. The date and merchant tables are
    stored and counted first: if they are small they are sent to all tasks, so that the wide rows are not
    shuffled for them. Users, accounts and devices are looked up for the distinct combinations of their
    keys, narrow rows; the wide rows are shuffled once, to those.
    """
    dims = dict(zip(ATTRIBUTES, (users, accounts, devices, merchants, dates), strict=True))
    attrs = {key: dim.select(key, *[F.col(c).alias(name) for c, name in ATTRIBUTES[key].items()])
             for key, dim in dims.items()}
    owners = fact.select(*OWNERS).distinct()
    for key in OWNERS:
        owners = left_lookup(owners, attrs[key], key)
    described = [c for key in OWNERS for c in ATTRIBUTES[key].values()]
    owners = owners.select(*[F.col(key).alias(f"_{key}") for key in OWNERS], *described)
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in OWNERS]
    wide = fact.join(owners, same, "left").drop(*[f"_{key}" for key in OWNERS])
    for key, rows in (("merchant_id", MERCHANT_ROWS), ("date_key", CALENDAR_ROWS)):
        dim = written(attrs[key], key)
        if dim.count() <= rows:
            wide = wide.join(F.broadcast(dim), key, "left")
        else:
            nulls = "transaction_id" if key == "merchant_id" else None
            wide = left_lookup(wide, dim, key, spread_nulls_by=nulls)
    described = [c for key, attrs in ATTRIBUTES.items() for c in (key, *attrs.values())]
    return wide.select("transaction_id", *described, *MEASURES)
