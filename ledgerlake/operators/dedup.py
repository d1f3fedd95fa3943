"""Keeping one row per key, and measuring how often keys repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.columns import ratio


def keep_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest `latest_by`.

    Ties fall to the greatest remaining columns, so the survivor never depends on task order. The
    filter on row_number lets Spark place a WindowGroupLimit before the shuffle: every map task
    sends at most one row per key, which keeps a hot key from flooding one reducer.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [F.col(c).desc_nulls_last() for c in (*latest_by, *rest)]
    return (
        df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_any(df: DataFrame, keys: Sequence[str], repeatable: bool = True) -> DataFrame:
    """One row per key. Without `repeatable` Spark may pick any copy, which is a little cheaper."""
    return keep_latest(df, keys, ()) if repeatable else df.dropDuplicates(list(keys))


def key_groups(key: str) -> Column:
    """Number of distinct keys where NULL counts as one key."""
    return F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("long")), F.lit(0))


def repeat_stats(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, surplus rows and their share, in one pass."""
    return (
        df.agg(F.count(F.lit(1)).alias("total_rows"), key_groups(key).alias("distinct_keys"))
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
        .withColumn("duplicate_rate", ratio(F.col("duplicate_rows"), F.col("total_rows")))
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row counts."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    )
