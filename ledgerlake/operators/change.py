"""Applying changes: upserts by business key and change-data-capture logs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, FractionalType, LongType,
                               NumericType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

from ledgerlake.operators.dedup import keep_latest
from ledgerlake.sources.tables import write_table
from ledgerlake.sources.workspace import written


def upserted(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], version: Sequence[str],
) -> DataFrame:
    """Current rows and updates, one row per key: the greatest `version` wins, updates win ties.

    A column that the updates leave out keeps its current value. A NULL key is a key like any other.
    """
    omitted = [c for c in current.columns if c not in updates.columns]
    if omitted:
        known = current.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *omitted)
        same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
        updates = updates.join(known, same, "left").drop(*[f"_key_{k}" for k in keys])
    both = current.withColumn("_fresh", F.lit(0)).unionByName(updates.withColumn("_fresh", F.lit(1)))
    return keep_latest(both, keys, [*version, "_fresh"]).drop("_fresh")


def upsert_partitions(
    current: DataFrame, updates: DataFrame, path: str, keys: Sequence[str],
    version: Sequence[str], partition: str, fmt: str = "parquet", check_moves: bool = False,
) -> None:
    """Upsert into a partitioned table in place, rewriting only the partitions that change.

    A key must keep its partition value. A move between partitions that the updates touch is refused
    before anything is written; `check_moves` looks for moves out of all others as well, which scans
    the keys of the whole table. The updates are stored once, and the new partitions are completed in
    the shared folder first, because a plan must not overwrite what it reads.
    """
    updates = written(updates, "updates")
    # As many values as there are partitions; as literals they prune the scan of the table.
    values = [r[0] for r in updates.select(partition).distinct().collect()]
    known = F.col(partition).isin([v for v in values if v is not None])
    touched = current.filter(known | F.col(partition).isNull() if None in values else known)
    moved = (current if check_moves else touched).join(
        updates.select(*keys, F.col(partition).alias("_to")), list(keys)).filter(
        ~F.col(partition).eqNullSafe(F.col("_to")))
    if not moved.isEmpty():
        raise ValueError(f"updates move keys to another {partition}; rewrite the table instead")
    ready = written(upserted(touched, updates, keys, version), "upsert")
    (ready.hint("rebalance", partition).write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).save(path))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table with a frame that may read it: staged in the shared folder first."""
    write_table(written(df, "replace"), path, partition_by=partition_by)


#: The names by which connectors say in a schema block how a column is encoded.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
CLOCKS = {"micros": ("io.debezium.time.MicroTimestamp",),
          "millis": ("io.debezium.time.Timestamp", "org.apache.kafka.connect.data.Timestamp"),
          "nanos": ("io.debezium.time.NanoTimestamp",)}
DAYS = ("io.debezium.time.Date", "org.apache.kafka.connect.data.Date")

_TYPES = ("fields array<struct<field: string, fields: array<struct<field: string, name: string,"
          " parameters: map<string, string>>>>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that it uses several times but that is to be evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _once(value: Column) -> Column:
    """A column that is computed where it stands: Spark does not move it into later filters."""
    return F.explode(F.array(value))


def unscaled_text(text: Column, scale: Column) -> Column:
    """A number sent as the base64 text of its unscaled value (big-endian, signed), as decimal text.

    Exact up to 38 digits; NULL for anything that is not such a text.
    """
    sound = text.rlike("^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$") & (
        F.length(text).between(1, 24))

    def number(digits: Column) -> Column:
        negative = digits >= "8"
        fill = F.when(negative, F.lit("F")).otherwise(F.lit("0"))

        def parts(wide: Column) -> Column:  # 16, 56 and 56 bits, of which the first are signed
            high, middle, low = (F.conv(F.substring(wide, at, n), 16, 10).cast("decimal(17,0)")
                                 for at, n in ((1, 4), (5, 14), (19, 14)))
            signed = (high - F.when(negative, 65536).otherwise(0)).cast("decimal(5,0)")
            rest = (middle * F.lit(Decimal(1 << 56)) + low).cast("decimal(38,0)")
            return F.try_add(F.try_multiply(signed, F.lit(Decimal(1 << 112))), rest).try_cast("decimal(38,0)")
        return _let(F.lpad(digits, F.lit(32), fill), parts)

    def printed(value: Column) -> Column:
        digits = F.lpad(F.abs(value).cast("string"), F.greatest(F.length(F.abs(value).cast("string")), scale + 1),
                        F.lit("0"))
        return F.concat(F.when(value < 0, "-").otherwise(""), F.left(digits, F.length(digits) - scale),
                        F.when(scale > 0, F.concat(F.lit("."), F.right(digits, scale))).otherwise(""))
    raw = F.unbase64(F.when(sound, text))
    return _let(_let(F.hex(F.when(F.octet_length(raw) <= 16, raw)), number), printed)


def _decoded(name: str, kind: DataType, scale: int | None, clock: str | None) -> Column:
    """A column from its text `r.name`: by the schema block if it is there, else as told."""
    text = F.col("r").getField(name)
    said = F.get(F.filter("types", lambda f: f["field"] == name), F.lit(0))
    if isinstance(kind, NumericType):
        by_name = F.when(said["name"] == DECIMAL,
                         unscaled_text(text, F.coalesce(said["parameters"]["scale"].try_cast("int"), F.lit(0))))
        if scale is not None:  # base64 has no point, so a text with one is the number itself
            by_name = by_name.when(said["name"].isNull(), F.coalesce(unscaled_text(text, F.lit(scale)), text))
        value = by_name.otherwise(text).try_cast(kind)
        return F.when(~F.isnan(value), value) if isinstance(kind, FractionalType) and not isinstance(
            kind, DecimalType) else value
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        whole, out = text.try_cast("bigint"), None
        for unit, at in (("micros", whole), ("millis", F.try_multiply(whole, F.lit(1000))),
                         ("nanos", F.floor(whole / 1000).cast("bigint"))):
            named = said["name"].isin(*CLOCKS[unit])
            named = (named | said["name"].isNull()) if clock == unit else named
            moment = F.timestamp_micros(at)
            out = out.when(named, moment) if out is not None else F.when(named, moment)
        days = F.date_from_unix_date(text.try_cast("int"))
        return out.when(said["name"].isin(*DAYS), days.cast("timestamp")).otherwise(
            text.try_cast("timestamp")).cast(kind)
    return text.try_cast(kind) if isinstance(kind, (BooleanType, StringType)) else text


def read_changes(
    lines: DataFrame, row_schema: str | StructType, position: str = "lsn", keys: Sequence[str] = (),
    decimals: Mapping[str, int] | None = None, micros: Sequence[str] = (), millis: Sequence[str] = (),
) -> DataFrame:
    """Debezium-style envelopes (`value` text) as `value`, `op`, `position`, `row` and `usable`.

    Deletes carry the row in `before`, everything else in `after`. The bare payload and the
    `{"schema": ..., "payload": ...}` form are read. A schema block says how each column is encoded:
    exact decimals as base64 of their unscaled bytes, clocks in milli-, micro- or nanoseconds, dates in
    days. Without one, `decimals` (name -> scale) names the columns that come as base64, `micros` and
    `millis` those that come as such clocks; all others are plain. Decimals stay exact to 38 digits.

    `usable` is false without JSON, operation, position, row or key, and where a column has a value
    that cannot be read as its type. Tombstones (NULL) are left out.
    """
    kinds = StructType.fromDDL(row_schema) if isinstance(row_schema, str) else row_schema
    plain = (NumericType, TimestampType, TimestampNTZType, DateType, BooleanType, StringType)
    raw = StructType([StructField(f.name, StringType() if isinstance(f.dataType, plain) else f.dataType)
                      for f in kinds])
    body = StructType([StructField("op", StringType()), StructField("source", StructType(
        [StructField(position, LongType())])), StructField("before", raw), StructField("after", raw)])
    outer = StructType([*body, StructField("payload", StringType()), StructField("schema", StringType())])
    # a payload is parsed only where there is one; `_once` keeps filters from parsing anew
    whole = lines.filter(F.col("value").isNotNull()).select("value", _once(F.from_json("value", outer)).alias("w"))
    inner = whole.select("value", "w", _once(F.when(F.col("w.payload").isNotNull(), F.from_json("w.payload", body)).otherwise(
        F.struct(*[F.col(f"w.{c}").alias(c) for c in body.names]))).alias("p"))
    tables = F.from_json("w.schema", _TYPES)["fields"]
    described = F.filter(tables, lambda f: f["field"] == F.when(F.col("p.op") == "d", "before").otherwise("after"))
    events = inner.select(
        "value", "p.op", F.col("p.source").getField(position).alias("position"),
        F.when(F.col("p.op") == "d", F.col("p.before")).otherwise(F.col("p.after")).alias("r"),
        F.get(described, F.lit(0))["fields"].alias("types"))
    clocks = {**dict.fromkeys(micros, "micros"), **dict.fromkeys(millis, "millis")}
    row = F.struct(*[_decoded(f.name, f.dataType, (decimals or {}).get(f.name), clocks.get(f.name)).alias(f.name)
                     for f in kinds])
    read = events.select("value", "op", "position", "r", _once(F.when(F.col("r").isNotNull(), row)).alias("row"))
    usable = F.col("op").isin("c", "u", "d", "r") & F.col("position").isNotNull() & F.col("row").isNotNull()
    for key in keys:
        usable = usable & F.col("row").getField(key).isNotNull()
    for f in kinds:
        lost = F.col("r").getField(f.name).isNotNull() & F.col("row").getField(f.name).isNull()
        usable = usable & ~lost
    return read.select("value", "op", "position", "row", F.coalesce(usable, F.lit(False)).alias("usable"))


def decode_changes(lines: DataFrame, row_schema: str | StructType, **options) -> DataFrame:
    """The envelopes that can be applied as op, position and the row's columns; see `read_changes`."""
    return read_changes(lines, row_schema, **options).filter("usable").select("op", "position", "row.*")


def malformed_changes(lines: DataFrame, row_schema: str | StructType, **options) -> DataFrame:
    """The text of envelopes that cannot be applied; see `read_changes`."""
    return read_changes(lines, row_schema, **options).filter("not usable").select("value")


def apply_changes(changes: DataFrame, keys: Sequence[str], position: str = "position") -> DataFrame:
    """The table after the log: the last change of each key, unless that was a delete."""
    return keep_latest(changes, keys, [position]).filter(F.col("op") != "d").drop("op", position)
