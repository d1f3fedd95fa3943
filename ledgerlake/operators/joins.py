"""Joins that keep their shape under skew: left lookups, orphan checks, as-of lookups.

No join here forces a broadcast. Spark compares the size of a side with
`spark.sql.autoBroadcastJoinThreshold` (and, at run time, with its adaptive twin): small sides are
broadcast, larger ones go through a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NULL_SPREAD = 512


def left_lookup(
    left: DataFrame, lookup: DataFrame, key: str, spread_nulls_by: str | None = None,
    spread: int = NULL_SPREAD,
) -> DataFrame:
    """Left join on one key. NULL keys match nothing.

    With `spread_nulls_by` (a well-distributed column of `left`) the NULL-key rows are spread over
    `spread` extra key values, so a mostly-NULL key does not send those rows to one reducer.
    """
    if spread_nulls_by is None:
        return left.join(lookup, key, "left")
    # pmod(hash, 1) is always 0 but, unlike a literal, stays a real join key for the planner.
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_nulls_by), F.lit(spread)))
    return (
        left.withColumn("_salt", F.coalesce(salt, F.lit(0).cast("long")))
        .join(lookup.withColumn("_salt", zero), [key, "_salt"], "left")
        .drop("_salt")
    )


def orphan_keys(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
) -> DataFrame:
    """Distinct non-NULL child keys that the parent lacks.

    The child is made distinct first (partial aggregation), so a hot key crosses the network once
    per task; an anti join needs no distinct parent.
    """
    keys = child.select(F.col(child_key).alias("orphan")).filter("orphan IS NOT NULL").distinct()
    known = parent.select(F.col(parent_key).alias("orphan"))
    return keys.join(known, "orphan", "left_anti")


def as_of(
    labels: DataFrame, features: DataFrame, key: str, label_time: str, feature_time: str,
    version: str, values: Sequence[str], slice_by: str = "day", rows_per_task: int = 1_000_000,
) -> DataFrame:
    """For every label row, the newest feature row of its key with feature_time <= label_time.

    Feature rows repeated for one (key, feature_time) are settled by the greatest `version`, NULL being
    the least, and equal versions by the greatest values. Labels without a key or a time see nothing.

    Scale: a key may own a large share of all rows, so no task ever sees a whole key. Time is cut
    into slices; one row per (key, slice) carries the last feature of earlier slices forward, and
    inside a slice labels look back only at that slice's features. A (key, slice) with more than
    `rows_per_task` labels is dealt out to several tasks, each with its own copy of the slice's
    features. Nothing is capped: features that no label can see are the only rows left out. Choose
    `slice_by` ("day", "hour", "minute") so that the features of one key in one slice fit a task.
    """
    payload = F.struct(F.col(feature_time).alias("feature_time"),
                       *[F.col(v).alias(v) for v in values])
    settled = (
        features.filter(F.col(key).isNotNull() & F.col(feature_time).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(feature_time).alias("_time"))
        .agg(F.max(F.struct(F.col(version).alias("version"), payload.alias("payload")))["payload"]
             .alias("_feature"))
        .withColumn("_slice", F.date_trunc(slice_by, "_time"))
    )
    # Labels that can see nothing stay out of the joins, where they would all share one key.
    keyless = labels.filter(F.col(key).isNull() | F.col(label_time).isNull())
    labels = labels.filter(F.col(key).isNotNull() & F.col(label_time).isNotNull())
    label_slice = F.date_trunc(slice_by, F.col(label_time))

    # One row per (key, slice): label count, and the last feature of that slice, if any.
    per_slice = (
        labels.groupBy(F.col(key).alias("_key"), label_slice.alias("_slice"))
        .agg(F.count(F.lit(1)).alias("_labels"))
        .withColumn("_last", F.lit(None).cast(settled.schema["_feature"].dataType))
        .unionByName(
            settled.groupBy("_key", "_slice")
            .agg(F.max_by("_feature", "_time").alias("_last"))
            .withColumn("_labels", F.lit(0).cast("long")))
        .groupBy("_key", "_slice")
        .agg(F.sum("_labels").alias("_labels"), F.first("_last", ignorenulls=True).alias("_last"))
    )
    earlier = (Window.partitionBy("_key").orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    spine = (
        per_slice.withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
        .filter(F.col("_labels") > 0)
        .select("_key", "_slice", "_carry",
                F.ceil(F.col("_labels") / F.lit(rows_per_task)).cast("int").alias("_parts"))
    )

    queries = (
        labels.withColumns({"_key": F.col(key), "_slice": label_slice})
        .join(spine, ["_key", "_slice"])
        .select(
            "_key", "_slice", F.col(label_time).alias("_time"), F.lit(1).alias("_side"), "_carry",
            F.pmod(F.xxhash64(*labels.columns), F.col("_parts")).alias("_part"),
            F.lit(None).cast(settled.schema["_feature"].dataType).alias("_feature"),
            F.struct(*labels.columns).alias("_label"))
    )
    visible = (
        settled.join(spine, ["_key", "_slice"])
        .select(
            "_key", "_slice", "_time", F.lit(0).alias("_side"),
            F.lit(None).cast(settled.schema["_feature"].dataType).alias("_carry"),
            F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_parts") - 1).cast("long")))
            .alias("_part"),
            "_feature", F.lit(None).cast(queries.schema["_label"].dataType).alias("_label"))
    )
    # Features sort before labels of the same instant, so an equal timestamp counts as known.
    so_far = (Window.partitionBy("_key", "_slice", "_part").orderBy("_time", "_side")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = F.coalesce(F.last("_feature", ignorenulls=True).over(so_far), F.col("_carry"))
    return (
        queries.unionByName(visible)
        .withColumn("_seen", seen)
        .filter(F.col("_side") == 1)
        .select("_label.*", "_seen.*")
        .unionByName(keyless.select(*labels.columns, F.lit(None).cast(
            settled.schema["_feature"].dataType).alias("_seen")).select(*labels.columns, "_seen.*"))
    )
