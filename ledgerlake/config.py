"""Domain values, table contracts and lake roots. Everything deployment-specific is data here."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they decide results and must stay as they are. -----------------------------

TRANSACTION_TYPES = ("deposit", "withdraw", "transfer", "payment")
TRANSACTION_STATUSES = ("success", "failed", "pending")
CHANNELS = ("app", "web", "atm", "UNKNOWN")
MISSING_CHANNEL = "UNKNOWN"
CURRENCY = "VND"

FEATURE_DAYS = 90
BALANCE_TOLERANCE = 1e-6
TOP_KEY_SHARE = 0.05
DEFAULT_RSD = 0.05

STREAM_WINDOW = "5 minutes"
# A 5-minute window is final once event time has passed its end by so much: 10 seconds out of order
# and 60 seconds late.
STREAM_CLOSE_DELAY = "70 seconds"
DEDUP_TTL = "30 minutes"
BURST_WINDOW = "10 seconds"
BURST_THRESHOLD = 100

FRESHNESS_MINUTES = {"offline": 60, "streaming": 5, "unified": 15}

# --- Table contracts: fixed values as well --------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """One source table: which columns must exist with which kind, its key, its Silver layout."""

    strings: tuple[str, ...]
    timestamps: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    def kinds(self) -> dict[str, str]:
        declared = dict.fromkeys(self.strings, "string")
        declared.update(dict.fromkeys(self.timestamps, "timestamp"))
        declared.update(dict.fromkeys(self.dates, "date"))
        return declared


TABLES: dict[str, TableSpec] = {
    "users": TableSpec(
        ("user_id", "full_name", "email", "phone"), ("created_at",), key=("user_id",)),
    "accounts": TableSpec(
        ("account_id", "user_id", "account_type", "currency"), ("created_at",),
        key=("account_id",)),
    "merchants": TableSpec(("merchant_id", "merchant_name", "category"), key=("merchant_id",)),
    "devices": TableSpec(
        ("device_id", "user_id", "device_type", "os"), ("first_seen_at",), key=("device_id",)),
    "transactions": TableSpec(
        ("transaction_id", "account_id", "user_id", "device_id", "type", "currency", "status",
         "channel", "merchant_id", "counterparty_account_id"),
        ("timestamp", "ingested_at"), key=("transaction_id",), partition_by=("event_date",)),
    "balance_snapshots": TableSpec(
        ("account_id",), dates=("snapshot_date",), key=("account_id", "snapshot_date"),
        partition_by=("snapshot_date",)),
    "login_events": TableSpec(
        ("login_id", "user_id", "device_id"), ("login_ts",), key=("login_id",),
        partition_by=("login_date",)),
}

# Columns of a raw stream event, in order.
EVENT_FIELDS = (
    "transaction_id", "account_id", "user_id", "device_id", "type", "amount", "currency",
    "status", "channel", "old_balance", "new_balance", "merchant_id",
    "counterparty_account_id", "timestamp", "ingested_at",
)

GOLD_PARTITIONS: dict[str, tuple[str, ...]] = {
    "dim_user": (),
    "dim_account": (),
    "dim_merchant": (),
    "dim_device": (),
    "dim_date": (),
    "fact_transactions": ("event_date",),
    "fact_login_events": ("event_date",),
    "fact_balance_snapshot": ("snapshot_date",),
    "obt_transaction_enriched": ("event_date",),
    "feat_user_90d": (),
    "opt_merchant_performance": (),
}


@dataclass(frozen=True)
class Lakehouse:
    """Where the zones live and which Spark data source stores them (`parquet`, `delta`, ...)."""

    root: str
    fmt: str = "parquet"

    def path(self, zone: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{table}"
