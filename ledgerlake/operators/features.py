"""User features: 90-day offline, 5-minute stream, and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions.columns import window_end, window_start

# Published feature names.
TOTAL = "f_user_total_transactions_90d"
AVERAGE = "f_user_avg_transaction_amount_90d"
FAILED_RATE = "f_user_failed_transaction_rate_90d"
MERCHANTS = "f_user_distinct_merchants_90d"
STREAM_COUNT = "f_stream_transaction_count_5m"
STREAM_TOTAL = "f_stream_total_amount_5m"
STREAM_BURST = "f_stream_burst_activity_flag"


def newest(df: DataFrame, clock: str) -> Column:
    """The greatest value of `clock` as a scalar subquery; the job fails if there is none."""
    top = F.coalesce(F.max(clock), F.raise_error(F.lit(f"no {clock}: the table is empty"))
                     .cast("timestamp"))
    return df.agg(top.alias("newest")).scalar()


def user_features_90d(
    fact: DataFrame, users: DataFrame, days: int = config.FEATURE_DAYS,
) -> DataFrame:
    """One row per user over the `days` before the newest transaction, both ends included.

    The reference time stays in the plan as a scalar subquery. The bound on `event_date` follows
    from the one on `timestamp` and lets Spark prune date partitions.
    """
    until = newest(fact, "timestamp")
    since = until - F.make_interval(days=F.lit(days))
    recent = fact.filter(F.col("timestamp").between(since, until))
    if "event_date" in fact.columns:
        recent = recent.filter(F.col("event_date") >= F.to_date(since))
    per_user = recent.groupBy("user_id").agg(
        F.count(F.lit(1)).alias(TOTAL),
        F.avg("amount").alias(AVERAGE),
        (F.count_if(F.col("status") == "failed") / F.count(F.lit(1))).alias(FAILED_RATE),
        F.count_distinct("merchant_id").alias(MERCHANTS),
    )
    return (
        users.select("user_id")
        .join(per_user, "user_id", "left")
        .fillna({TOTAL: 0, AVERAGE: 0.0, FAILED_RATE: 0.0, MERCHANTS: 0})
        .withColumn("event_timestamp", until)
        .withColumn("created_timestamp", F.current_timestamp())
    )


def stream_features(events: DataFrame, width: str = config.STREAM_WINDOW) -> DataFrame:
    """Count and total per user and event-time window, over rows already known to be on time."""
    return (
        events.groupBy("user_id", F.window("event_time", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum("amount").alias("total_amount"))
        .select("user_id", F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"), "count", "total_amount")
    )


def stream_features_with_burst(
    events: DataFrame, bursts: DataFrame, width: str = config.STREAM_WINDOW,
    burst_width: str = config.BURST_WINDOW,
) -> DataFrame:
    """Window features plus a flag: did any of the window's rows arrive during a burst?

    Rows are summed per (user, window, arrival window) before the join, so a burst that holds much
    of the data is joined as a few sums per user instead of row by row.
    """
    partial = events.groupBy(
        "user_id", window_end(F.col("event_time"), width).alias("event_timestamp"),
        window_start(F.col("ingested_at"), burst_width).alias("arrival"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    hot = bursts.filter("burst_detected").select(
        F.col("window_start").alias("arrival"), F.lit(True).alias("hot"))
    return (
        partial.join(hot, "arrival", "left")
        .groupBy("user_id", "event_timestamp")
        .agg(F.sum("n").alias(STREAM_COUNT), F.sum("total").alias(STREAM_TOTAL),
             F.bool_or(F.coalesce(F.col("hot"), F.lit(False))).alias(STREAM_BURST))
    )


def unified_features(offline: DataFrame, stream: DataFrame) -> DataFrame:
    """Every offline user with its newest stream window, if any."""
    names = [c for c in stream.columns if c not in ("user_id", "event_timestamp")]
    newest_window = stream.groupBy("user_id").agg(
        F.max_by(F.struct(*names), "event_timestamp").alias("_w"),
        F.max("event_timestamp").alias("stream_event_timestamp"),
    ).select("user_id", "stream_event_timestamp", "_w.*")
    return offline.join(newest_window, "user_id", "left")
