"""Exported topic segments as a source of messages, bounded or live, with offsets per partition.

A topic is a folder of Parquet segments, `partition=N/*.parquet`, whose rows have `offset`,
`arrived_at` and `value`. The source reads offsets `from` (included) `to` (excluded) of every
partition. It lists segments by the offset range in their footers, so it opens only those it needs, one
task for each; a task passes Arrow batches on. Live, the offsets reached are kept in the checkpoint, and
a restarted query goes on from there, in segments that were added as well as in those it had begun.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ledgerlake.sources.folders import qualified

FORMAT = "topic_segments"
SCHEMA = "value string, arrived_at timestamp, partition string, position long"


@dataclass(frozen=True)
class Segment:
    path: str
    partition: str
    first: int
    last: int


@dataclass
class Stretch(InputPartition):
    """The offsets of one segment that are to be read."""
    path: str
    partition: str
    start: int
    end: int


class Topic:
    """The segments of a folder; footers that were read are remembered."""

    def __init__(self, path: str):
        self.path, self._known = path, {}

    def segments(self) -> list[Segment]:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True, allow_not_found=True))
        for info in found:
            name = info.path.rsplit("/", 1)[-1]
            if info.type != pyarrow.fs.FileType.File or name[0] in "._" or info.path in self._known:
                continue
            with fs.open_input_file(info.path) as f:
                said = pq.ParquetFile(f).metadata
                column = said.schema.names.index("offset")
                ranges = [said.row_group(i).column(column).statistics for i in range(said.num_row_groups)]
            folder = next(x for x in info.path.split("/") if x.startswith("partition="))
            if said.num_rows:
                self._known[info.path] = Segment(info.path, folder.removeprefix("partition="),
                                                 min(r.min for r in ranges), max(r.max for r in ranges))
        return list(self._known.values())

    def earliest(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for s in self.segments():
            out[s.partition] = min(s.first, out.get(s.partition, s.first))
        return out

    def latest(self) -> dict[str, int]:
        """The offset after the last one of each partition."""
        out: dict[str, int] = {}
        for s in self.segments():
            out[s.partition] = max(s.last + 1, out.get(s.partition, 0))
        return out

    def offsets(self, said: str, unknown: dict[str, int]) -> dict[str, int]:
        """`earliest`, `latest`, or a JSON object; partitions that it leaves out are as in `unknown`."""
        if said in ("earliest", "latest"):
            return self.earliest() if said == "earliest" else self.latest()
        return unknown | {str(k): int(v) for k, v in json.loads(said).items()}

    def stretches(self, start: dict[str, int], end: dict[str, int]) -> list[Stretch]:
        """What to read; a partition without a start is new and read from its beginning."""
        out = []
        for s in self.segments():
            low, high = max(s.first, start.get(s.partition, 0)), min(s.last + 1, end.get(s.partition, 0))
            if low < high:
                out.append(Stretch(s.path, s.partition, low, high))
        return out


def _messages(root: str, stretch: Stretch) -> Iterator[pa.RecordBatch]:
    fs, _ = pyarrow.fs.FileSystem.from_uri(root)
    with fs.open_input_file(stretch.path) as f:
        for batch in pq.ParquetFile(f).iter_batches(columns=["offset", "arrived_at", "value"]):
            at = batch.column("offset")
            own = batch.filter(pc.and_(pc.greater_equal(at, stretch.start), pc.less(at, stretch.end)))
            yield pa.RecordBatch.from_arrays(
                [own.column("value").cast(pa.string()), own.column("arrived_at").cast(pa.timestamp("us", "UTC")),
                 pa.array([stretch.partition] * own.num_rows, pa.string()), own.column("offset")],
                ["value", "arrived_at", "partition", "position"])


class _Bounded(DataSourceReader):
    def __init__(self, path: str, starting: str, ending: str):
        self.path, self.starting, self.ending = path, starting, ending

    def partitions(self) -> list[Stretch]:
        topic = Topic(self.path)
        return topic.stretches(topic.offsets(self.starting, topic.earliest()),
                               topic.offsets(self.ending, topic.latest())) or [Stretch("", "", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from _messages(self.path, partition)


class _Live(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting, self.topic = path, starting, Topic(path)

    def initialOffset(self) -> dict:
        return self.topic.offsets(self.starting, self.topic.earliest())

    def latestOffset(self) -> dict:
        return self.topic.latest()

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return self.topic.stretches(start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _messages(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class TopicSegments(DataSource):
    """Options: `path`, `startingOffsets` (earliest, latest or JSON), and `endingOffsets` when bounded."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Bounded:
        return _Bounded(self.options["path"], self.options.get("startingOffsets", "earliest"),
                        self.options.get("endingOffsets", "latest"))

    def streamReader(self, schema) -> _Live:
        return _Live(self.options["path"], self.options.get("startingOffsets", "latest"))


def export_topic(messages: DataFrame, path: str) -> None:
    """Add messages (`partition`, `offset`, `arrived_at`, `value`) to a topic's segments."""
    (messages.select("partition", F.col("offset").cast("long").alias("offset"), "arrived_at", "value")
     .repartition("partition").sortWithinPartitions("partition", "offset")
     .write.mode("append").partitionBy("partition").parquet(path))


def topic_lines(spark: SparkSession, path: str, starting: str = "earliest", ending: str = "latest",
                streaming: bool = False) -> DataFrame:
    """Messages of an exported topic, in the same shape as a broker's (see `events.kafka_lines`)."""
    spark.dataSource.register(TopicSegments)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).option("startingOffsets", starting)
    if not streaming:
        reader = reader.option("endingOffsets", ending)
    return reader.option("path", qualified(spark, path)).load()
