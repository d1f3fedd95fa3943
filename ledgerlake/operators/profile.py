"""Profiles of a table: shares, rates, skew, balances, freshness, cardinality."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions.columns import balance_consistent, ratio
from ledgerlake.sources.workspace import written


def rate(condition: Column) -> Column:
    """Share of rows for which the condition is true (NULL counts as false)."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def value_shares(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows and share per value; NULL values are left out of both."""
    counts = (
        df.select(value.alias(name)).filter(F.col(name).isNotNull())
        .groupBy(name).agg(F.count(F.lit(1)).alias("row_count"))
    )
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("share", F.col("row_count") / total)


def rate_among(rows: Column, condition: Column) -> Column:
    """Share of the given rows for which the condition is true (NULL counts as false)."""
    return F.avg(F.when(rows, F.coalesce(condition, F.lit(False)).cast("double")))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the share of NULLs of each column."""
    return df.agg(*[rate(F.col(c).isNull()).alias(f"{c}_null_rate") for c in columns])


def failed_rule_rates(transactions: DataFrame) -> DataFrame:
    """How often failed rows keep their balance, and how often overdrawn rows have failed."""
    failed = F.col("status") == "failed"
    overdrawn = (F.col("type") != "deposit") & (F.col("amount") > F.col("old_balance"))
    return transactions.agg(
        rate_among(failed, F.col("new_balance") == F.col("old_balance"))
        .alias("failed_balance_kept_rate"),
        rate_among(overdrawn, failed).alias("overdrawn_failed_rate"),
    )


def balance_rule_by_status(transactions: DataFrame) -> DataFrame:
    """Rows that keep the balance rule, per status (failed rows do not move the balance)."""
    kept = balance_consistent(
        F.col("type"), F.col("old_balance"), F.col("new_balance"), F.col("amount"))
    return transactions.groupBy("status").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(kept).alias("consistent_rows"))


def closing_balance(transactions: DataFrame) -> DataFrame:
    """Last balance per account and day. Ties on the clock fall to the greater id and balance."""
    last = F.struct("timestamp", "ingested_at", "transaction_id", "new_balance")
    return transactions.groupBy(
        "account_id", F.to_date("timestamp").alias("snapshot_date"),
    ).agg(F.max_by("new_balance", last).alias("closing_balance"))


def latest_balance(accounts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Newest snapshot balance of every account, 0.0 where there is none."""
    newest = snapshots.groupBy("account_id").agg(
        F.max_by("closing_balance", F.struct("snapshot_date", "closing_balance"))
        .alias("balance"))
    return (
        accounts.select("account_id", "user_id").join(newest, "account_id", "left")
        .fillna({"balance": 0.0})
    )


def list_by_key(
    df: DataFrame, key: str, value: str, name: str, chunk: int = 10_000,
) -> DataFrame:
    """Sorted values per key in chunks of `chunk`, as (key, part, list); NULL keys are left out.

    Part p holds the values at positions p * chunk and on, at every size. Positions come from a range
    sort over (key, value): a partition numbers its own rows, and what a key has in the partitions
    before is added. So a hot key, even one with a single value, is spread over many tasks.
    """
    rows = df.select(key, value).filter(F.col(key).isNotNull()).withColumn(
        "_row", F.monotonically_increasing_id())
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(parts, key, value, "_row")
                     .withColumn("_task", F.spark_partition_id()), "ranged")
    before = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(key, "_task").agg(F.count(F.lit(1)).alias("_n")).select(
        key, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(key, "_task").orderBy(value, "_row")) - 1
    return (
        ranged.withColumn("_place", place).join(offsets, [key, "_task"])
        .groupBy(key, F.floor((F.col("_place") + F.col("_before")) / F.lit(chunk)).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(value).isNull(), F.col(value).alias("v"))))
             .alias("_list"))
        .select(key, "part", F.transform("_list", lambda x: x["v"]).alias(name))
    )


def key_counts(df: DataFrame, key: str, name: str = "transaction_count") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_keys(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n most frequent keys; equal counts are ordered by key."""
    return key_counts(df, key).orderBy(F.desc("transaction_count"), key).limit(n)


def top_key_count(distinct_keys: int, share: float = config.TOP_KEY_SHARE) -> int:
    return max(1, math.ceil(distinct_keys * share))


def member_rate(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Share of rows whose key is one of `members`; rows without a key are not."""
    flags = members.select(key).distinct().withColumn("_member", F.lit(True))
    return df.select(key).join(flags, key, "left").agg(
        F.count(F.lit(1)).alias("row_count"), rate(F.col("_member")).alias("member_rate"))


def skew_profile(
    df: DataFrame, key: str, share: float = config.TOP_KEY_SHARE,
) -> DataFrame:
    """How unevenly rows fall on keys: one row of counts, ratios and the top keys' share (%).

    Counts per key are folded into a histogram (count -> number of keys). Its size is bounded: k
    different counts need at least k*(k+1)/2 rows, so 10^12 rows give at most 1.4 million entries,
    usually a few thousand. Only this histogram meets in one task, never the keys. Keys with equal
    counts are interchangeable, so the top share is exact.
    """
    histogram = key_counts(df, key, "c").groupBy("c").agg(F.count(F.lit(1)).alias("keys"))
    above = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.select(
        "c", "keys",
        F.coalesce(F.sum("keys").over(above), F.lit(0)).alias("above"),
        F.sum("keys").over(Window.partitionBy()).alias("all_keys"),
    ).withColumn("top_keys", F.greatest(F.lit(1).cast("long"),
                                        F.ceil(F.col("all_keys") * F.lit(share))))
    taken = F.greatest(F.lit(0).cast("long"),
                       F.least(F.col("keys"), F.col("top_keys") - F.col("above")))
    total = F.sum(F.col("c") * F.col("keys"))
    median = F.percentile("c", F.lit(0.5), F.col("keys"))
    return ranked.agg(
        total.alias("total_rows"),
        F.sum("keys").alias("distinct_keys"),
        F.max("top_keys").alias("top_keys"),
        (F.sum(F.col("c") * taken) / total * 100).alias("top_share_pct"),
        F.max("c").alias("max_rows"),
        F.min("c").alias("min_rows"),
        (total / F.sum("keys")).alias("mean_rows"),
        median.alias("median_rows"),
        (F.max("c") / median).alias("max_median_ratio"),
    )


def events_per_minute(df: DataFrame, clock: str = "ingested_at") -> DataFrame:
    return df.groupBy(F.date_trunc("minute", clock).alias("minute")).agg(
        F.count(F.lit(1)).alias("event_count"))


def minutes_between(per_minute: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Per-minute rows of one day whose HH:mm lies between `first` and `last`, both included."""
    clock = F.date_format("minute", "HH:mm")
    return per_minute.filter(
        (F.to_date("minute") == F.to_date(F.lit(day))) & clock.between(first, last))


def late_rate(df: DataFrame, arrival: str = "ingested_at", event: str = "timestamp") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  rate(F.col(arrival) > F.col(event)).alias("late_rate"))


def repeatable_sample(df: DataFrame, by: str, n: int = 20, seed: int = 42) -> DataFrame:
    """n rows that look random but are the same on every run: the smallest salted hashes."""
    drawn = F.md5(F.concat_ws("|", F.col(by).cast("string"), F.lit(str(seed))))
    return df.orderBy(drawn, by).limit(n)


def freshness(
    clocks: Mapping[str, tuple[DataFrame, str]], reference: Column,
    targets: Mapping[str, int] = config.FRESHNESS_MINUTES,
) -> DataFrame:
    """Per named table: newest event, minutes behind `reference`, target and verdict."""
    out = None
    for name, (df, clock) in clocks.items():
        row = df.agg(F.max(clock).alias("newest_event")).select(
            F.lit(name).alias("component"), "newest_event",
            ((F.unix_micros(reference) - F.unix_micros("newest_event")) / F.lit(60_000_000))
            .alias("lag_minutes"),
            F.lit(targets[name]).alias("target_minutes"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn(
        "fresh", F.coalesce(F.col("lag_minutes") <= F.col("target_minutes"), F.lit(False)))


# --- Distinct counting ------------------------------------------------------------------------


def distinct_exact(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias(f"distinct_{key}s"))


def _checked(rsd: float) -> float:
    if not 0 < rsd < 1:
        raise ValueError(f"rsd must lie strictly between 0 and 1, not {rsd}")
    return rsd


def distinct_approx(df: DataFrame, key: str, rsd: float = config.DEFAULT_RSD) -> DataFrame:
    return df.agg(F.approx_count_distinct(key, _checked(rsd)).alias(f"approx_distinct_{key}s"))


def distinct_compare(df: DataFrame, key: str, rsd: float = config.DEFAULT_RSD) -> DataFrame:
    """Exact and approximate count of one column with absolute and relative (%) error.

    Both counts come from one scan; the sketch is a fixed-size partial aggregate.
    """
    counts = df.agg(F.count_distinct(key).alias("exact_count"),
                    F.approx_count_distinct(key, _checked(rsd)).alias("approx_count"))
    error = F.abs(F.col("approx_count") - F.col("exact_count"))
    return counts.withColumn("absolute_error", error).withColumn(
        "relative_error_pct", ratio(error, F.col("exact_count")) * 100)


def cardinality_report(
    df: DataFrame, columns: Sequence[str], rsd: float = config.DEFAULT_RSD,
) -> DataFrame:
    """Approximate distinct count of several columns from one scan, one row per column."""
    sketches = df.agg(*[F.approx_count_distinct(c, _checked(rsd)).alias(c) for c in columns])
    return sketches.unpivot([], list(columns), "column_name", "approx_distinct")


def top_members(df: DataFrame, key: str, share: float = config.TOP_KEY_SHARE) -> DataFrame:
    """The most frequent keys, a `share` of all of them (one at least); equal counts go by key.

    The histogram of counts says which counts are wholly in and how many of the keys at the cut are.
    Only those are ranked, in ranges of the key whose sizes are added up, so that no task sorts all of
    them and nothing is collected. The histogram is sent to all tasks; see `skew_profile` for its bound.
    """
    counts = written(key_counts(df, key, "c"), "key-counts")
    histogram = counts.groupBy("c").agg(F.count(F.lit(1)).alias("keys"))
    above = F.coalesce(F.sum("keys").over(
        Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("keys").over(Window.partitionBy()) * F.lit(share)))
    cuts = histogram.withColumn("_left", wanted - above).filter("_left > 0").select("c", "keys", "_left")
    chosen = counts.join(F.broadcast(cuts), "c")
    whole = chosen.filter("keys <= _left").select(key)
    tied = written(chosen.filter("keys > _left").select(key, "_left").repartitionByRange(key)
                   .withColumn("_task", F.spark_partition_id()), "tied")
    before = F.coalesce(F.sum("_n").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = tied.groupBy("_task").agg(F.count(F.lit(1)).alias("_n")).select("_task", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_task").orderBy(key))
    ranked = tied.withColumn("_place", place).join(offsets, "_task")
    return whole.unionByName(ranked.filter("_place + _before <= _left").select(key))


def daily_sketches(df: DataFrame, columns: Sequence[str], day: str, lg_k: int = 12) -> DataFrame:
    """`day`, `column_name` and a mergeable sketch of the column's distinct values on that day.

    NULLs do not count. Sketches have a bounded size, 2^lg_k bytes or so, whatever the rows.
    """
    # a sketch is taken of text, so that any column type can be counted
    by_day = df.groupBy(F.col(day).cast("date").alias("day")).agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in columns])
    return by_day.unpivot(["day"], list(columns), "column_name", "sketch")


def add_sketches(sketches: DataFrame, path: str) -> None:
    """Store the sketches of some days; days that are there already are replaced, others untouched."""
    (sketches.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def distinct_between(sketches: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Approximate distinct values per column over a range of days, both included, from stored sketches."""
    if first is not None:
        sketches = sketches.filter(F.col("day") >= F.to_date(F.lit(first)))
    if last is not None:
        sketches = sketches.filter(F.col("day") <= F.to_date(F.lit(last)))
    return sketches.groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))
