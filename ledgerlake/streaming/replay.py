"""Stream semantics on a captured stream, as ordinary batch jobs.

Rows carry their arrival order in (`ingested_at`, `seq`); `ingested_at` stands for processing
time. Nothing here sorts the stream as a whole or walks through one key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions.columns import interval, window_end, window_start
from ledgerlake.sources.workspace import written

ARRIVAL = ("ingested_at", "seq")


def _arrival(order: Sequence[str] = ARRIVAL) -> Column:
    return F.struct(*order)


def mark_repeats(
    events: DataFrame, key: str = "transaction_id", ttl: str = config.DEDUP_TTL,
) -> DataFrame:
    """Adds `is_duplicate`: the key was first seen at most `ttl` earlier. Keys are not NULL.

    A repeat does not prolong the time to live, so after `ttl` the next arrival is new again. Keys
    whose arrivals all fit into one `ttl` (practically all) need their first arrival only, a
    partially aggregated minimum. The others go through `first_sights`.
    """
    clock, seq = ARRIVAL
    columns = events.columns
    if seq not in columns:
        events = events.withColumn(seq, F.lit(None).cast("long"))
    # One row per key, stored: both branches read it.
    spans = written(events.groupBy(key).agg(
        F.min(_arrival()).alias("_first"), F.max(clock).alias("_last")), "spans")
    lasting = F.coalesce(F.col("_last") > F.col(f"_first.{clock}") + interval(ttl), F.lit(False))
    # Of rows that are alike in key and arrival, resent as they were, exactly one is the first.
    alike = F.row_number().over(Window.partitionBy(key, *ARRIVAL).orderBy(F.lit(1)))
    brief = (
        events.join(spans.filter(~lasting), key).withColumn("_nth", alike)
        .select(*columns, (~_arrival().eqNullSafe(F.col("_first")) | (F.col("_nth") > 1))
                .alias("is_duplicate")))

    long_lived = spans.filter(lasting).select(key)
    if long_lived.isEmpty():
        return brief
    open_events = written(events.join(long_lived, key, "left_semi"), "long-lived")
    instants = written(
        open_events.groupBy(key, F.unix_micros(clock).alias("_at")).agg(F.min(seq).alias("_seq")),
        "instants")
    firsts = first_sights(instants, key, "_at", ttl).join(instants, [key, "_at"])
    sighted = (F.col("_sight") & F.col("_seq").eqNullSafe(F.col(seq)) & (F.col("_nth") == 1))
    lasting_marked = (
        open_events.withColumn("_at", F.unix_micros(clock))
        .join(firsts.withColumn("_sight", F.lit(True)), [key, "_at"], "left")
        .withColumn("_nth", alike)
        .select(*columns, (~F.coalesce(sighted, F.lit(False))).alias("is_duplicate")))
    return brief.unionByName(lasting_marked)


def first_sights(instants: DataFrame, key: str, at: str, ttl: str) -> DataFrame:
    """The (key, instant) pairs that start a time to live, given all distinct pairs.

    From each instant a pointer leads to the first instant more than `ttl` later; the sights are
    what the pointers reach from a key's earliest instant. Pointers are doubled each round (one
    step, two steps, four, ...), so a key that lives for thousands of `ttl` takes a dozen rounds.
    Every join is on (key, instant) and every sort covers one minute of a key, so rows of one hot
    key are spread over all tasks.
    """
    jumps = written(_next_after(instants, key, at, ttl), "pointers")
    reached = instants.groupBy(key).agg(F.min(at).alias(at))
    frontier = reached
    while True:
        landed = reached.join(jumps, [key, at]).select(key, F.col("_next").alias(at))
        frontier = written(landed, "sights")
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)
        onward = jumps.select(key, F.col(at).alias("_next"), F.col("_next").alias("_later"))
        jumps = written(
            jumps.join(onward, [key, "_next"]).select(key, at, F.col("_later").alias("_next")),
            "pointers")


def _next_after(instants: DataFrame, key: str, at: str, ttl: str) -> DataFrame:
    """For each instant the first one of the same key more than `ttl` later, where there is one."""
    minute = F.col("_t") - F.pmod(F.col("_t"), F.lit(60_000_000))
    lag = F.unix_micros(F.timestamp_micros(F.col(at)) + interval(ttl))
    nothing = F.lit(None).cast("long")
    arrivals = instants.select(key, F.col(at).alias("_t"), F.lit(1).alias("_kind"),
                               nothing.alias(at)).withColumn("_minute", minute)
    asked = instants.select(key, lag.alias("_t"), F.lit(0).alias("_kind"),
                            F.col(at)).withColumn("_minute", minute)
    # What lies beyond the minute of a question: the earliest instant of any later minute.
    later = Window.partitionBy(key).orderBy(F.desc("_minute")).rowsBetween(
        Window.unboundedPreceding, -1)
    beyond = (
        arrivals.unionByName(asked)
        .groupBy(key, "_minute").agg(F.min(F.when(F.col("_kind") == 1, F.col("_t"))).alias("_min"))
        .withColumn("_t", F.min("_min").over(later)).filter("_t IS NOT NULL")
        .select(key, "_minute", "_t", F.lit(1).alias("_kind"), nothing.alias(at)))
    # Going back in time, a question comes before an arrival of the same instant (not "later").
    back = Window.partitionBy(key, "_minute").orderBy(F.desc("_t"), "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        arrivals.unionByName(asked).unionByName(beyond)
        .withColumn("_next", F.min(F.when(F.col("_kind") == 1, F.col("_t"))).over(back))
        .filter((F.col("_kind") == 0) & F.col("_next").isNotNull())
        .select(key, at, "_next"))


def window_closings(
    events: DataFrame, width: str = config.STREAM_WINDOW, delay: str = config.STREAM_CLOSE_DELAY,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Per window that holds rows: `closed_at`, the arrival after which its rows are late.

    A window is closed by the first arrival whose event time lies `delay` or more past its end. So
    each event is credited to the last window it closes (a partially aggregated minimum per grid
    point), and a window's closing is the minimum over its own and all later grid points. Only the
    grid meets in one task for that: 288 points a day, about a million in ten years.
    """
    row_end = window_end(F.col("event_time"), width)
    closes = window_start(F.col("event_time") - interval(delay), width)
    nobody = F.lit(None).cast(events.select(_arrival(order).alias("a")).schema["a"].dataType)
    # Each row speaks for two grid points, in one pass: the one it closes and the one it sits in.
    points = F.array(
        F.struct(closes.alias("window_end"), _arrival(order).alias("closed_at"),
                 F.lit(False).alias("used")),
        F.struct(row_end.alias("window_end"), nobody.alias("closed_at"), F.lit(True).alias("used")))
    grid = (
        events.select(F.inline(points))
        .groupBy("window_end").agg(F.min("closed_at").alias("closed_at"),
                                   F.bool_or("used").alias("used"))
    )
    onward = Window.orderBy(F.desc("window_end")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return grid.withColumn("closed_at", F.min("closed_at").over(onward)).filter("used").select(
        "window_end", "closed_at")


def mark_late(
    events: DataFrame, width: str = config.STREAM_WINDOW, delay: str = config.STREAM_CLOSE_DELAY,
    seen_until: Column | None = None, order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Adds `is_late`: the row arrived after its window had been closed for good.

    Give it deduplicated rows. `seen_until` is the greatest event time of everything that arrived
    before this frame (a stream's carried state); windows it has already closed stay closed.
    """
    closings = window_closings(events, width, delay, order)
    late = F.coalesce(F.col("closed_at") < _arrival(order), F.lit(False))
    if seen_until is not None:
        late = late | F.coalesce(F.col("window_end") + interval(delay) <= seen_until,
                                 F.lit(False))
    return (
        events.withColumn("window_end", window_end(F.col("event_time"), width))
        .join(closings, "window_end", "left")
        .withColumn("is_late", late)
        .select(*events.columns, "is_late")
    )


def on_time(events: DataFrame) -> DataFrame:
    """First copies that arrived before their window closed: what the window features count.

    The first copies are written out once, since lateness looks at them twice: at three narrow
    columns to find when windows closed, and at the rows themselves.
    """
    unique = mark_repeats(events).filter(~F.col("is_duplicate")).drop("is_duplicate")
    return mark_late(written(unique, "first-copies")).filter(~F.col("is_late")).drop("is_late")


def burst_windows(
    events: DataFrame, threshold: int = config.BURST_THRESHOLD,
    width: str = config.BURST_WINDOW, clock: str = "ingested_at",
) -> DataFrame:
    """Raw arrivals (repeats included) per window, and whether they reach the threshold.

    Works on a batch or, with a watermark on `clock`, on a stream. Counts are combined on the map
    side, so no single task sees all events.
    """
    counts = events.groupBy(F.window(clock, width).alias("w")).agg(
        F.count(F.lit(1)).alias("event_count"))
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "event_count", (F.col("event_count") >= threshold).alias("burst_detected"))
