"""Live jobs built from the stream operators.

`run_job` flags the repeats of each micro-batch of one streaming query and judges it row by row: repeats,
late rows and on-time rows go to folders of their own, on-time rows are added to their windows, and
windows that the batch has closed are written. Each micro-batch overwrites its own folders and reads only
those of earlier ones, so running it again changes nothing, and the result does not depend on how the
input falls into micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake import config
from ledgerlake.functions.columns import burst_line, event_line, feature_line
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.operators.features import stream_features
from ledgerlake.streaming.dedup import TTL_MS, Seen, timed
from ledgerlake.streaming.events import quarantined, valid_events
from ledgerlake.streaming.replay import burst_windows, mark_late


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Set session options (dots written as double underscores) and put the old ones back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def to_table(
    df: DataFrame, path: str, checkpoint: str, bounded: bool, fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a table. `bounded` stops after what is there now."""
    writer = df.writeStream.format(fmt).outputMode("append").option(
        "checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def run_raw(lines: DataFrame, path: str, checkpoint: str, bounded: bool = False) -> StreamingQuery:
    """Pass raw messages through unchanged."""
    return to_table(lines.select("value"), path, checkpoint, bounded)


def run_marking(
    events: DataFrame, path: str, checkpoint: str, bounded: bool = False, ttl_ms: int = TTL_MS,
) -> StreamingQuery:
    """Deduplicate and write all events with `is_duplicate`, a folder `batch=` for each micro-batch.

    The keys that were seen are kept beside the checkpoint.
    """
    seen = Seen(events.sparkSession, f"{checkpoint}/seen", ttl_ms=ttl_ms)

    def keep(batch: DataFrame, batch_id: int) -> None:
        out = f"{path}/batch={batch_id}"
        seen.flagged(batch, batch_id).write.mode("overwrite").parquet(out)
        seen.remember(batch, batch.sparkSession.read.parquet(out), batch_id)

    writer = timed(events).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def read_stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table as a stream, all files that are there in one micro-batch."""
    return spark.readStream.schema(schema).parquet(path)


def window_features(unique: DataFrame, delay: str = config.STREAM_CLOSE_DELAY) -> DataFrame:
    """Streaming window features; a window is emitted once, when nothing can change it any more.

    Spark moves the watermark between micro-batches, so a row that becomes late inside its own
    micro-batch is still counted. Unlike a watermark per source partition, Spark's is the maximum
    over all of them; widen `delay` when one partition lags behind. `run_job` has no such limits.
    """
    return stream_features(unique.withWatermark("event_time", delay))


def run_refining(
    unique: DataFrame, root: str, checkpoint: str, bounded: bool = False,
    delay: str = config.STREAM_CLOSE_DELAY,
) -> StreamingQuery:
    """Write every refinement of a window as soon as it is known, for readers who cannot wait.

    Each micro-batch overwrites its own folder, so running it again changes nothing;
    `refined_features` picks the last word on each window.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    writer = window_features(unique, delay).writeStream.outputMode("update").foreachBatch(
        keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def refined_features(spark: SparkSession, root: str) -> DataFrame:
    """The newest state of each (user, window) that `run_refining` has written."""
    return keep_latest(spark.read.parquet(root), ["user_id", "window_start"], ["batch"]).drop(
        "batch")


def burst_monitor(
    arrivals: DataFrame, threshold: int = config.BURST_THRESHOLD, clock: str = "arrived_at",
    delay: str = "10 seconds",
) -> DataFrame:
    """Streaming burst counts over raw arrivals; empty windows emit nothing.

    A window is final `delay` after its end; an arrival may be out of order by that much.
    """
    return burst_windows(arrivals.withWatermark(clock, delay), threshold, clock=clock)


def _folder(batch_id: int) -> str:
    return f"{batch_id:012d}"


LIVE_ARRIVAL = ("arrived_at", "partition", "position")
_PROGRESS = "seen timestamp, arrived timestamp"
_WINDOWS = ("user_id string, window_start timestamp, window_end timestamp, count long,"
            " total_amount double")
_BURSTS = "window_start timestamp, window_end timestamp, event_count long"


def _summed(parts: DataFrame) -> DataFrame:
    """One row per window of all its parts."""
    keys = [c for c in parts.columns if c in ("user_id", "window_start", "window_end")]
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in parts.columns if c not in keys))


def job_batch(
    spark: SparkSession, root: str, burst_delay: str = "10 seconds",
    delay: str = config.STREAM_CLOSE_DELAY,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over marked events (`is_duplicate`) that writes under `root`:

    * `marked`, `late`, `on_time`: the rows of the batch, judged one by one;
    * `features`, `bursts`: windows that the batch has closed. A burst window that gets an arrival
      after that gets another row, with what is added; readers sum up;
    * `open_features`, `open_bursts`: windows still open, as far as they have come;
    * `progress`: the greatest event time and arrival so far, one row.

    Only the open windows and the progress of the batch before are read back.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, name: str) -> None:
            df.write.mode("overwrite").parquet(f"{root}/{name}/{_folder(batch_id)}")

        def before(name: str, schema: str) -> DataFrame:
            return spark.read.schema(schema).parquet(f"{root}/{name}/{_folder(batch_id - 1)}")

        def windows(name: str, schema: str, parts: DataFrame, reached, after: str) -> None:
            columns = [c.split()[0] for c in schema.split(", ")]
            parts = parts.select(*columns)
            if batch_id:
                parts = parts.union(before(f"open_{name}", schema))
            parts = _summed(parts).persist()
            limit = F.col("window_end") + F.expr(f"INTERVAL {after}")
            closed = F.coalesce(limit <= F.lit(reached).cast("timestamp"), F.lit(False))
            put(parts.filter(closed).select(*columns), name)
            put(parts.filter(~closed).select(*columns), f"open_{name}")
            parts.unpersist()

        seen, arrived = before("progress", _PROGRESS).first() if batch_id else (None, None)
        batch = batch.persist()
        try:
            put(batch, "marked")
            judged = mark_late(
                batch.filter("NOT is_duplicate").drop("is_duplicate"), delay=delay,
                seen_until=None if seen is None else F.lit(seen), order=LIVE_ARRIVAL).persist()
            put(judged.filter("is_late").drop("is_late"), "late")
            timely = judged.filter("NOT is_late").drop("is_late")
            put(timely, "on_time")
            newest = batch.agg(
                F.max(F.when(~F.col("is_duplicate"), F.col("event_time"))).alias("seen"),
                F.max("arrived_at").alias("arrived")).first()
            now = tuple(max((x for x in pair if x is not None), default=None)
                        for pair in ((seen, newest.seen), (arrived, newest.arrived)))
            windows("features", _WINDOWS, stream_features(timely), now[0], delay)
            windows("bursts", _BURSTS, burst_windows(batch, 1, clock="arrived_at"), now[1], burst_delay)
            put(spark.createDataFrame([now], _PROGRESS), "progress")
            judged.unpersist()
        finally:
            batch.unpersist()
    return step


def job_output(
    spark: SparkSession, root: str, name: str, threshold: int = config.BURST_THRESHOLD,
) -> DataFrame:
    """All that a job has written under a name (see `job_batch`).

    For `features` and `bursts` that is one row per window, those included which are still open.
    """
    out = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{name}")
    if name not in ("features", "bursts"):
        return out
    newest = _batches(spark, f"{root}/progress")[-1]
    out = _summed(out.unionByName(spark.read.schema(out.schema).parquet(f"{root}/open_{name}/{newest}")))
    return out if name == "features" else out.withColumn(
        "burst_detected", F.col("event_count") >= threshold)


def _batches(spark: SparkSession, path: str) -> list[str]:
    """The folders that micro-batches have completed in a folder, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().getName() for f in found)


def tagged_lines(df: DataFrame, tag: str) -> DataFrame:
    """The text form of an output under its tag (FEATURE, BURST, DUPLICATE, LATE)."""
    if tag == "FEATURE":
        line = feature_line(F.col("user_id"), F.col("window_start"), F.col("window_end"),
                            F.col("count"), F.col("total_amount"))
    elif tag == "BURST":
        line = burst_line(F.col("window_start"), F.col("window_end"), F.col("event_count"),
                          F.col("burst_detected"))
    else:
        line = event_line(tag, F.col("transaction_id"), F.col("user_id"), F.col("amount"),
                          F.col("timestamp"))
    return df.select(F.lit(tag).alias("tag"), line.alias("line"))


def run_job(
    lines: DataFrame, root: str, bounded: bool = False, threshold: int = config.BURST_THRESHOLD,
    ttl_ms: int = TTL_MS, text_lines: bool = False,
) -> dict[str, StreamingQuery]:
    """The whole job over raw messages (`value`, and where they arrived; see `parse_lines`).

    Events go through `job_batch`; messages that cannot be used go to `quarantine`. With
    `text_lines`, every output is also written as tagged text under `text`. A bounded run stops
    after what is there now; `job_output` has the windows left open as well.
    """
    spark = lines.sparkSession
    step, seen = job_batch(spark, root), Seen(spark, f"{root}/seen", ttl_ms=ttl_ms)

    def whole(batch: DataFrame, batch_id: int) -> None:
        step(seen.flagged(batch, batch_id), batch_id)
        seen.remember(batch, spark.read.parquet(f"{root}/marked/{_folder(batch_id)}"), batch_id)
        if text_lines:
            for tag, name in (("FEATURE", "features"), ("BURST", "bursts"), ("LATE", "late"),
                              ("DUPLICATE", "marked")):
                df = spark.read.parquet(f"{root}/{name}/{_folder(batch_id)}")
                if tag == "DUPLICATE":
                    df = df.filter("is_duplicate")
                elif tag == "BURST":
                    df = df.withColumn("burst_detected", F.col("event_count") >= threshold)
                tagged_lines(df, tag).select("line").write.mode("overwrite").text(
                    f"{root}/text/{tag}/{_folder(batch_id)}")

    writer = timed(valid_events(lines)).writeStream.foreachBatch(whole).option(
        "checkpointLocation", f"{root}/_checkpoints/events")
    queries = {"events": (writer.trigger(availableNow=True) if bounded else writer).start(),
               "quarantine": to_table(quarantined(lines), f"{root}/quarantine",
                                      f"{root}/_checkpoints/quarantine", bounded)}
    if bounded:
        for query in queries.values():
            query.awaitTermination()
    return queries
