"""90-day user features kept up to date load by load, from stored daily partials.

A load brings whole days of the fact table. Its partials (one row per user, merchant and day) replace
those of the same days, so a load may run again. Then only users are computed anew that have rows on a
loaded day, had some there before, or have some on a day that the window has left; all others keep
their features. What is read: the load, the partials of the window and of the days it has left, and of
the fact table the one day in which the window begins.

Rows without a time are in no window and have no partials. A day that lost all its rows cannot be
loaded, as no row names it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.operators.features import AVERAGE, FAILED_RATE, MERCHANTS, TOTAL
from ledgerlake.sources.folders import names
from ledgerlake.sources.workspace import written

PARTIALS = ("user_id string, merchant_id string, rows long, amounts long, amount double, failed long,"
            " newest timestamp, day date")


def daily_partials(fact: DataFrame) -> DataFrame:
    """What a day adds to the features, per user and merchant."""
    return (
        fact.filter("timestamp IS NOT NULL")
        .groupBy("user_id", "merchant_id", F.to_date("timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count("amount").alias("amounts"), F.sum("amount").alias("amount"),
             F.count_if(F.col("status") == "failed").alias("failed"), F.max("timestamp").alias("newest"))
        .select(*(c.split()[0] for c in PARTIALS.split(", ")))
    )


def stored_partials(spark: SparkSession, path: str) -> DataFrame:
    if not names(spark, path):
        return spark.createDataFrame([], PARTIALS)
    return spark.read.schema(PARTIALS).parquet(path)


def _from_partials(partials: DataFrame) -> DataFrame:
    rows = F.sum("rows")
    return partials.groupBy("user_id").agg(
        rows.alias(TOTAL), (F.sum("amount") / F.sum("amounts")).alias(AVERAGE),
        (F.sum("failed") / rows).alias(FAILED_RATE), F.count_distinct("merchant_id").alias(MERCHANTS))


def refresh_user_features(
    path: str, load: DataFrame, fact: DataFrame, users: DataFrame, before: DataFrame | None = None,
    days: int = config.FEATURE_DAYS,
) -> DataFrame:
    """The features of all `users` (one row each) after a load, as `user_features_90d` gives them.

    `path` holds the partials and is brought up to date. `fact` has all loaded rows, this load's
    included; `before` are the features after the load before. Without them all users are computed.
    """
    spark = users.sparkSession
    loaded = written(daily_partials(load), "load")
    replaced = stored_partials(spark, path).join(loaded.select("day").distinct(), "day", "left_semi")
    touched = written(replaced.select("user_id").union(loaded.select("user_id")).distinct(), "touched")
    # days share tasks, a large one is split: a file or a few per day, not sixteen
    (loaded.hint("rebalance", "day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))

    held = names(spark, path)
    if not held:
        raise ValueError("no transaction with a time: the window has no end")
    stored, day = stored_partials(spark, path), F.col("day")
    last = F.lit(max(held).split("=", 1)[1]).cast("date")
    until = F.timestamp_micros(F.lit(stored.filter(day == last).agg(F.unix_micros(F.max("newest"))).first()[0]))
    back = F.make_interval(days=F.lit(days))
    begins = F.to_date(until - back)
    edge = fact.filter((F.to_date("timestamp") == begins) & (F.col("timestamp") >= until - back))
    if "event_date" in fact.columns:
        edge = edge.filter(F.col("event_date") == begins)
    window = stored.filter(day > begins).unionByName(daily_partials(edge))

    ended = before.agg(F.unix_micros(F.max("event_timestamp"))).first()[0] if before is not None else None
    if ended is None:
        per_user = _from_partials(window)
    else:
        # the days that the begin of the window has passed, whichever way it went
        began = F.to_date(F.timestamp_micros(F.lit(ended)) - back)
        left = stored.filter(day.between(F.least(began, begins), F.greatest(began, begins))).select("user_id")
        anew = written(touched.union(left).distinct(), "anew")
        kept = before.select("user_id", TOTAL, AVERAGE, FAILED_RATE, MERCHANTS).join(anew, "user_id", "left_anti")
        per_user = kept.unionByName(_from_partials(window.join(anew, "user_id", "left_semi")))
    return (
        users.select("user_id").join(per_user, "user_id", "left")
        .fillna({TOTAL: 0, AVERAGE: 0.0, FAILED_RATE: 0.0, MERCHANTS: 0})
        .withColumn("event_timestamp", until)
        .withColumn("created_timestamp", F.current_timestamp())
    )
