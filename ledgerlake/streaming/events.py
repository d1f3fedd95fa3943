"""Stream sources and parsing of raw JSON events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions.columns import all_of

#: Where and when a message came in: name, type, and what stands for unknown.
ARRIVAL = (("arrived_at", "timestamp", "1970-01-01 00:00:00"), ("partition", "string", ""),
           ("position", "long", -1))
REQUIRED = ("transaction_id", "user_id", "amount", "timestamp")


def kafka_lines(
    spark: SparkSession, servers: str, topic: str = "transactions.raw",
    starting: str = "latest", streaming: bool = True,
) -> DataFrame:
    """Raw messages of a topic as `value`, and where and when the broker took them in: `arrived_at`,
    `partition`, `position`.

    Needs Spark's Kafka package. A batch read is always bounded; use `starting="earliest"` for it.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka").option(
        "kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", starting).load().select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived_at"),
        F.col("partition").cast("string").alias("partition"), F.col("offset").alias("position"))


def file_lines(
    spark: SparkSession, path: str, streaming: bool = True, files_per_batch: int | None = None,
) -> DataFrame:
    """JSON lines from a folder, in the same shape as Kafka's.

    `arrived_at` is the file's time, `partition` its path, and `position` where in the file its
    block begins; lines of one block have no order.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("text")
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.col("_metadata.file_path").alias("partition"),
        F.col("_metadata.file_block_start").alias("position"))


def json_line(*columns: Column) -> Column:
    """Encode columns as one JSON object with ISO-8601 clocks (microseconds, no zone)."""
    return F.to_json(F.struct(*columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def parse_lines(lines: DataFrame) -> DataFrame:
    """Typed events plus the raw text and `malformed` (bad JSON, missing key, bad amount or time).

    Everything is read as text first, so one bad field cannot void a whole record, and amounts are
    accepted as numbers or as numeric text. Where the lines have them, `arrived_at`, `partition` and
    `position` are carried along; they are the order of arrival and never NULL.
    """
    arrival = [F.coalesce(c, F.lit(least).cast(kind)).alias(c) for c, kind, least in ARRIVAL
               if c in lines.columns]
    schema = ", ".join(f"`{name}` string" for name in (*config.EVENT_FIELDS, "seq"))
    fields = lines.select("value", *arrival, F.from_json("value", schema).alias("e"))
    typed = fields.select(
        "value", *[c for c, _, _ in ARRIVAL if c in lines.columns], "e.transaction_id", "e.user_id",
        F.col("e.amount").try_cast("double").alias("amount"),
        "e.timestamp",
        F.col("e.timestamp").try_cast("timestamp").alias("event_time"),
        F.col("e.ingested_at").try_cast("timestamp").alias("ingested_at"),
        F.col("e.seq").try_cast("long").alias("seq"),
    )
    usable = all_of(F.col(c).isNotNull() for c in (*REQUIRED, "event_time"))
    return typed.withColumn("malformed", ~usable)


def valid_events(lines: DataFrame) -> DataFrame:
    return parse_lines(lines).filter(~F.col("malformed")).drop("malformed", "value")


def quarantined(lines: DataFrame) -> DataFrame:
    """The raw text of records that cannot be used; keep it, a poison record must not stop a job."""
    bad = parse_lines(lines).filter("malformed")
    return bad.select("value", *[c for c, _, _ in ARRIVAL if c in bad.columns])


def topic_report(lines: DataFrame) -> DataFrame:
    """Per partition of a bounded read: messages, those that cannot be used, distinct ids, first and last offset."""
    parsed = parse_lines(lines)
    return parsed.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if("malformed").alias("malformed"),
        F.count_distinct("transaction_id").alias("transactions"),
        F.min("position").alias("first_position"), F.max("position").alias("last_position"))
