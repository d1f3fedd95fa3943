"""Column expressions. All of them are Catalyst built-ins, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config


def ensure_column(df: DataFrame, name: str, dtype: str, default=None) -> DataFrame:
    """Add `name` as a typed literal when the frame lacks it; otherwise leave the frame alone."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(dtype))


def cast_columns(df: DataFrame, kinds: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast the named columns. `strict` fails the job on bad text, otherwise it becomes NULL."""
    return df.withColumns({
        name: F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)
        for name, kind in kinds.items()
    })


def uncastable(kinds: Mapping[str, str]) -> Column:
    """True for rows in which some present value does not fit its declared type."""
    return any_of(
        F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        for name, kind in kinds.items()
    )


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def present(*names: str) -> Column:
    return all_of(F.col(n).isNotNull() for n in names)


def missing_any(*names: str) -> Column:
    return any_of(F.col(n).isNull() for n in names)


def negative_any(*names: str) -> Column:
    return any_of(F.col(n) < 0 for n in names)


def normalize_channel(channel: Column) -> Column:
    """NULL becomes the missing marker; text is trimmed and lower-cased.

    Source text equal to the marker is lower-cased too and so falls out of the domain later on.
    """
    return F.when(channel.isNull(), F.lit(config.MISSING_CHANNEL)).otherwise(
        F.lower(F.trim(channel)))


def structurally_valid() -> Column:
    """Required columns present, positive amount, no negative balance (NULL measures fail)."""
    return (
        present("transaction_id", "account_id", "user_id", "timestamp", "ingested_at")
        & (F.col("amount") > 0)
        & (F.col("old_balance") >= 0)
        & (F.col("new_balance") >= 0)
    )


def in_domain() -> Column:
    """Type, status, channel and currency all belong to the allowed sets."""
    return (
        F.col("type").isin(*config.TRANSACTION_TYPES)
        & F.col("status").isin(*config.TRANSACTION_STATUSES)
        & F.col("channel").isin(*config.CHANNELS)
        & (F.col("currency") == config.CURRENCY)
    )


def date_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def balance_consistent(
    kind: Column, old: Column, new: Column, amount: Column,
    tolerance: float = config.BALANCE_TOLERANCE,
) -> Column:
    """Deposits add and the other known types subtract `amount`; unknown types always pass."""
    moved = F.when(kind == "deposit", amount).otherwise(-amount)
    return F.when(kind.isin(*config.TRANSACTION_TYPES),
                  F.abs(new - (old + moved)) < tolerance).otherwise(F.lit(True))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, and 0 when there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def window_start(ts: Column, width: str = config.STREAM_WINDOW) -> Column:
    """Start of the epoch-aligned tumbling window that holds `ts`, in whole microseconds."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds(width) * 1_000_000)))


def window_end(ts: Column, width: str = config.STREAM_WINDOW) -> Column:
    """End of the epoch-aligned tumbling window that holds `ts`."""
    return window_start(ts, width) + interval(width)


def seconds(width: str) -> int:
    amount, unit = width.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def interval(width: str) -> Column:
    return F.expr(f"INTERVAL {width}")


def epoch_millis(text: Column) -> Column:
    """ISO-8601 text (read in the session zone) to epoch milliseconds."""
    return F.unix_millis(F.to_timestamp(text))


def iso_time(millis: Column) -> Column:
    """Epoch milliseconds to ISO-8601 text; the fraction appears only when there is one."""
    ts = F.timestamp_millis(millis)
    return F.when(F.pmod(millis, F.lit(1000)) == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def feature_line(user: Column, start: Column, end: Column, count: Column, total: Column) -> Column:
    """Text form of one window feature; `start` and `end` are timestamps."""
    return F.format_string(
        "user_id=%s | window=%s -> %s | count=%d | amount=%.2f",
        user, iso_time(F.unix_millis(start)), iso_time(F.unix_millis(end)), count, total)


def event_line(label: str, tx: Column, user: Column, amount: Column, when: Column) -> Column:
    """Text form of one stream event under a label such as LATE or DUPLICATE."""
    return F.format_string(
        "%s | transaction_id=%s | user_id=%s | amount=%.2f | event_time=%s",
        F.lit(label), tx, user, amount, when)


def burst_line(start: Column, end: Column, count: Column, burst: Column) -> Column:
    """Text form of one burst window: bounds in epoch milliseconds, count, verdict."""
    return F.format_string("(%d,%d,%d,%s)", F.unix_millis(start), F.unix_millis(end), count,
                           burst.cast("string"))


def mebibytes(size: Column) -> Column:
    return size / F.lit(1024 * 1024)
