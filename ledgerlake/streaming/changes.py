"""Change logs applied live: a keyed table that follows a stream of change envelopes.

The table is cut into buckets by key. It holds the last change of each key with its position, deletes
included, so that a change that comes late or again never undoes a newer one. Each micro-batch adds the
last changes of its keys, in a folder of its own, and then publishes a manifest that names the folders of
every bucket. When there would be more folders than buckets, a batch merges them all into its own. So
batches write about as much as they bring, and readers keep the last change of a key. Readers go by the newest manifest and so see whole
batches only; running a batch again starts from the manifest before it and gives the same table.

A line may carry a schema block, which makes its text many times the size of the row. So text is kept
compressed, and only of changes that could not be applied; what a batch stores for itself goes when the batch ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerlake.operators.change import read_changes
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.sources.folders import drop, names
from ledgerlake.sources.workspace import fresh_path

BUCKETS = 64
#: Manifests kept; what only older ones name is deleted.
KEPT = 3

_MANIFEST = "bucket int, batch long"


class LiveTable:
    """A table under `root` with the rows of `row_schema`, one per key."""

    def __init__(self, spark: SparkSession, root: str, row_schema: str, keys: Sequence[str],
                 buckets: int = BUCKETS, kept: int = KEPT, **reading):
        self.spark, self.root, self.keys = spark, root, list(keys)
        self.buckets, self.kept, self.reading = buckets, kept, reading
        self.kinds = StructType.fromDDL(row_schema)
        self.stored = StructType([StructField("_op", StringType()), StructField("_position", LongType()),
                                  *self.kinds])

    def _manifest(self, before: int | None = None) -> dict[int, list[int]]:
        """The batches that hold each bucket, as of the newest manifest (before a batch)."""
        known = [n for n in map(int, names(self.spark, f"{self.root}/manifests")) if before is None or n < before]
        if not known:
            return {}
        manifest: dict[int, list[int]] = {}
        for bucket, n in sorted(map(tuple, self.spark.read.schema(_MANIFEST).json(
                f"{self.root}/manifests/{max(known):020d}").collect())):  # a few rows a bucket
            manifest.setdefault(bucket, []).append(n)
        return manifest

    def _rows(self, manifest: dict[int, list[int]]) -> DataFrame:
        paths = [f"{self.root}/rows/{n:020d}/_bucket={b}" for b, of in sorted(manifest.items()) for n in of]
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*paths)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of lines (`value`): usable changes into the table, the others to `quarantine`."""
        read = read_changes(batch.select("value"), self.kinds, keys=self.keys, **self.reading)
        read = read.withColumn("value", F.when(~F.col("usable"), F.col("value")))
        path = fresh_path(self.spark, "changes")
        try:
            read.write.parquet(path)
            self._add(read.sparkSession.read.schema(read.schema).parquet(path), batch_id)
        finally:
            drop(self.spark, path)

    def _add(self, read: DataFrame, batch_id: int) -> None:
        folder = f"{batch_id:020d}"
        (read.filter("not usable").select("value").write.mode("overwrite").option("compression", "gzip")
         .text(f"{self.root}/quarantine/{folder}"))
        changes = read.filter("usable").select(
            F.col("op").alias("_op"), F.col("position").alias("_position"), "row.*")
        before = self._manifest(batch_id)
        # what the kept manifests name, and this batch, are then no more folders than buckets
        merge = len({n for of in before.values() for n in of}) >= max(1, self.buckets - self.kept)
        both = changes.unionByName(self._rows(before)) if merge else changes
        newest = keep_latest(self._bucketed(both), ["_bucket", *self.keys], ["_position"])
        (newest.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket")
         .parquet(f"{self.root}/rows/{folder}"))
        touched = [r[0] for r in self.spark.read.schema("_bucket int").parquet(
            f"{self.root}/rows/{folder}").distinct().collect()]  # names of folders only
        self._publish(before | {b: [*([] if merge else before.get(b, [])), batch_id] for b in touched}, folder)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _publish(self, manifest: dict[int, list[int]], folder: str) -> None:
        rows = [(b, n) for b, of in sorted(manifest.items()) for n in of]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode(
            "overwrite").json(f"{self.root}/manifests/{folder}")
        known = sorted(n for n in names(self.spark, f"{self.root}/manifests") if n <= folder)
        for old in known[:-self.kept]:
            drop(self.spark, f"{self.root}/manifests/{old}")
        named = {n for of in manifest.values() for n in of}
        for n in known[-self.kept:]:
            named |= {m for of in self._manifest(int(n) + 1).values() for m in of}
        for old in names(self.spark, f"{self.root}/rows"):
            if old < folder and int(old) not in named:
                drop(self.spark, f"{self.root}/rows/{old}")

    def start(self, lines: DataFrame, bounded: bool = False) -> StreamingQuery:
        """Follow a stream of lines; goes on from its checkpoint. `bounded` stops after what is there."""
        writer = lines.writeStream.foreachBatch(self.apply).option(
            "checkpointLocation", f"{self.root}/_checkpoint")
        return (writer.trigger(availableNow=True) if bounded else writer).start()

    def read(self) -> DataFrame:
        """The rows that are not deleted, as of the newest whole batch."""
        return (keep_latest(self._rows(self._manifest()), self.keys, ["_position"])
                .filter("_op <> 'd'").drop("_op", "_position"))

    def quarantined(self) -> DataFrame:
        """The text of changes that could not be applied."""
        return self.spark.read.option("recursiveFileLookup", "true").schema("value string").text(
            f"{self.root}/quarantine")
