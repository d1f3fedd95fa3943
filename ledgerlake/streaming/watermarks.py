"""Lateness by a watermark per source partition, of which idle partitions have no part.

Each source partition has a watermark: how far the event time of its own rows has come. What counts is
the least of all partitions that are not idle, which never moves back; a partition is idle when nothing
has arrived from it for a while, and counts again from its next row on. So a slow partition holds
windows open for its own rows, and one that has gone silent does not hold them open for ever.

Only a few rows per partition decide: its first arrival for each window's closing, and the first and
last arrival of each stretch of time shorter than the idle time. They are found by partial aggregates
and meet in one task, about 300 a day and partition; it walks through them in order of arrival with
one number per partition in hand. What it knows at the end is a table of one row per partition, from
which the next micro-batch goes on.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions.columns import interval, seconds, window_end, window_start
from ledgerlake.sources.folders import names
from ledgerlake.sources.workspace import written

#: How long a source partition may be silent before it counts as idle.
IDLE = "30 seconds"

STATE = "source string, reached long, last_at long"
_POINT = "kind int, at long, seq long, source string, reached long"
#: After all arrivals of one instant.
_AFTER = 2**63 - 1


def _walk(idle: int):
    """(kind, at, seq, source, reached): each step of the watermark (kind 1), then the state (kind 0).

    In the state, the row without a source is the watermark itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[str, int | None] = {}
        last: dict[str, int] = {}
        expiries: list[tuple[int, str]] = []
        live: set[str] = set()
        mark: int | None = None
        out: list[tuple] = []

        def settle(at: int, seq: int) -> None:
            nonlocal mark
            if not live or any(reached[s] is None for s in live):
                return
            least = min(reached[s] for s in live)
            if mark is None or least > mark:
                mark = least
                out.append((1, at, seq, None, mark))

        def arrive(source: str, at: int) -> None:
            last[source] = max(at, last.get(source, at))
            if source not in live:
                live.add(source)
                heapq.heappush(expiries, (last[source] + idle, source))

        for batch in batches:
            for kind, at, seq, source, came in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0 and source is None:
                    mark = came
                    continue
                while kind and expiries and expiries[0][0] < at:
                    due, silent = heapq.heappop(expiries)
                    if last[silent] + idle > due:
                        heapq.heappush(expiries, (last[silent] + idle, silent))
                    else:
                        live.discard(silent)
                        settle(due, _AFTER)
                arrive(source, at)
                known = reached.setdefault(source, None)
                if came is not None:
                    reached[source] = came if known is None else max(known, came)
                if kind:
                    settle(at, seq)
            yield _rows(out)
            out.clear()
        out += [(0, last[s], 0, s, r) for s, r in reached.items()]
        if mark is not None:
            out.append((0, 0, 0, None, mark))
        yield _rows(out)
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
        [c.split()[0] for c in _POINT.split(", ")])


def mark_late_by_source(
    events: DataFrame, source: str = "partition", idle: str = IDLE, width: str = config.STREAM_WINDOW,
    delay: str = config.STREAM_CLOSE_DELAY, state: DataFrame | None = None,
    clock: str = "ingested_at", seq: str = "seq",
) -> tuple[DataFrame, DataFrame]:
    """The events with `is_late`, and the state (`STATE`) after them.

    A row is late if, before it arrived, the watermark lay `delay` or more past the end of its window.
    `state` is what the frame before this one left; frames must follow in order of arrival. A NULL
    source is a source like any other. Rows without a clock are never late and move nothing.
    """
    spark = events.sparkSession
    at, key = F.unix_micros(clock), F.coalesce(F.col(source).cast("string"), F.lit(""))
    arrival = F.struct(at.alias("at"), F.col(seq).cast("long").alias("seq"))
    timed = events.filter(F.col(clock).isNotNull()).select(
        key.alias("source"), arrival.alias("arrival"),
        F.unix_micros(window_start(F.col("event_time") - interval(delay), width)).alias("closes"))
    cell = F.floor(F.col("arrival.at") / (seconds(idle) * 500_000))
    stretches = timed.groupBy("source", cell.alias("cell")).agg(
        F.min("arrival").alias("first"), F.max("arrival").alias("last"))
    nothing = F.lit(None).cast("long")
    ends = stretches.select("source", F.explode(F.array("first", "last")).alias("arrival"), nothing.alias("reached"))
    firsts = timed.filter("closes is not null").groupBy("source", "closes").agg(F.min("arrival").alias("arrival"))
    points = ends.unionByName(firsts.withColumnRenamed("closes", "reached")).select(
        F.lit(1).alias("kind"), "arrival.at", F.coalesce("arrival.seq", F.lit(-1)).alias("seq"), "source", "reached")
    if state is not None:
        points = points.unionByName(state.select(
            F.lit(0).alias("kind"), F.col("last_at").alias("at"), F.lit(0).cast("long").alias("seq"), "source", "reached"))
    walked = written(points.repartition(1).sortWithinPartitions("kind", "at", "seq")
                     .mapInArrow(_walk(seconds(idle) * 1_000_000), _POINT), "watermark")
    steps = walked.filter("kind = 1").select(F.col("reached").alias("end"), "at", "seq")
    before = None
    if state is not None:  # one row
        before = state.filter("source is null").agg(F.max("reached")).first()[0]
    # the steps rise, so each window end's closing is the first step that is not below it
    ends_used = events.select(F.unix_micros(window_end(F.col("event_time"), width)).alias("end")).distinct()
    closings = _first_step(ends_used, steps)
    own_end = F.unix_micros(window_end(F.col("event_time"), width))
    late = F.coalesce(F.col("_closed") < F.struct(at.alias("at"), F.coalesce(F.col(seq).cast("long"), F.lit(-1)).alias("seq")),
                      F.lit(False))
    if before is not None:
        late = late | F.coalesce(own_end <= before, F.lit(False))
    marked = events.withColumn("_end", own_end).join(
        closings.select(F.col("end").alias("_end"), F.col("closed").alias("_closed")), "_end", "left").withColumn(
        "is_late", late & F.col(clock).isNotNull()).select(*events.columns, "is_late")
    return marked, walked.filter("kind = 0").select("source", "reached", F.col("at").alias("last_at"))


def _first_step(ends: DataFrame, steps: DataFrame) -> DataFrame:
    """`end`, `closed` (at, seq): a minimum from the last end backwards, over the calendar of windows."""
    both = ends.select("end", F.lit(None).cast("struct<at: bigint, seq: bigint>").alias("closed"), F.lit(True).alias("used")
                       ).unionByName(steps.select("end", F.struct("at", "seq").alias("closed"), F.lit(False).alias("used")))
    grid = both.filter("end is not null").groupBy("end").agg(
        F.min("closed").alias("closed"), F.bool_or("used").alias("used"))
    onward = Window.orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return grid.withColumn("closed", F.min("closed").over(onward)).filter("used and closed is not null").drop("used")


def late_batch(spark: SparkSession, root: str, **options) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each micro-batch's events with `is_late` under `root`/marked.

    The state is carried in `root`/state, one small folder per micro-batch. A batch that is run again
    starts from the state before it and overwrites what it wrote.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        before = [n for n in names(spark, f"{root}/state") if int(n) < batch_id]
        state = spark.read.schema(STATE).parquet(f"{root}/state/{before[-1]}") if before else None
        marked, after = mark_late_by_source(written(batch, "arrived"), state=state, **options)
        marked.write.mode("overwrite").parquet(f"{root}/marked/{batch_id:012d}")
        after.coalesce(1).write.mode("overwrite").parquet(f"{root}/state/{batch_id:012d}")
    return step
