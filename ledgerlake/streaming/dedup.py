"""Deduplication of a live stream, one micro-batch at a time, with state kept by key.

The state is a folder per micro-batch with the keys that were new in it. All of them were first seen at
the time of that micro-batch, so a folder expires as a whole, and its name says when. A micro-batch is
joined to the folders that have not expired; no row passes through Python, and a micro-batch costs its own
rows and the keys of one time to live.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.sources.folders import drop, names

TTL_MS = 30 * 60 * 1000
ORDER = ("arrived_at", "partition", "position")
#: The time of a micro-batch. A batch that is run again has the same one.
CLOCK = "_batch_time"


def timed(events: DataFrame) -> DataFrame:
    """A stream whose rows carry the processing time of their micro-batch."""
    return events.withColumn(CLOCK, F.current_timestamp())


class Seen:
    """The keys that a stream has seen within `ttl_ms`, under `root`; of timed micro-batches (`timed`).

    `order` columns decide which copy inside one micro-batch came first; NULLs come before all else.
    Without them any copy of a micro-batch may be the first. A key is known for `ttl_ms` after it was new,
    not after it was last seen. A NULL key is a key like any other.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "transaction_id",
                 order: Sequence[str] = ORDER, ttl_ms: int = TTL_MS):
        self.spark, self.root, self.key, self.order, self.ttl_ms = spark, root, key, tuple(order), ttl_ms

    def _folders(self) -> dict[str, tuple[int, int]]:
        """Per folder: its micro-batch, and when it was."""
        return {n: tuple(map(int, n.split("-"))) for n in names(self.spark, self.root)}

    def _now(self, batch: DataFrame) -> int | None:
        row = batch.select(F.unix_millis(CLOCK).alias("now")).first()
        return row and row.now

    def flagged(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows with `is_duplicate`, without their clock."""
        now = self._now(batch)
        live = [f"{self.root}/{n}" for n, (of, at) in self._folders().items()
                if now is not None and of < batch_id and now < at + self.ttl_ms]
        by = [F.col(c) for c in self.order if c in batch.columns] or [F.lit(1)]
        rows = batch.drop(CLOCK).withColumn(
            "_nth", F.row_number().over(Window.partitionBy(self.key).orderBy(*by)))
        known = F.lit(False)
        if live:
            kind = batch.select(F.col(self.key).alias("_key")).schema
            # a key is in one folder at most, as it is new again only after that has expired
            seen = self.spark.read.schema(kind).parquet(*live).withColumn("_known", F.lit(True))
            rows = rows.join(seen, F.col(self.key).eqNullSafe(F.col("_key")), "left")
            known = F.col("_known").isNotNull()
        return rows.withColumn("is_duplicate", known | (F.col("_nth") > 1)).drop("_nth", "_key", "_known")

    def remember(self, batch: DataFrame, flagged: DataFrame, batch_id: int) -> None:
        """Store what is new in a flagged micro-batch, and delete what has expired."""
        now = self._now(batch)
        if now is None:
            return
        own = f"{batch_id:012d}-{now}"
        for n, (of, at) in self._folders().items():
            if at + self.ttl_ms <= now or (of == batch_id and n != own):
                drop(self.spark, f"{self.root}/{n}")
        (flagged.filter("NOT is_duplicate").select(F.col(self.key).alias("_key"))
         .write.mode("overwrite").parquet(f"{self.root}/{own}"))
