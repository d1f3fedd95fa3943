"""Compaction of the small files of a table only, ordered along a space-filling curve of two or more columns.

Ordering columns are numbers, dates or times. A table has `data`, where loads append partition folders, `compacted`, with a folder for each compaction,
and `manifests`. A manifest names the live files with their sizes, rows and least and greatest values of the
ordering columns, so a reader opens only files that can hold what it looks for. Files are never changed:
large ones keep their names, small ones are rewritten and no longer live in the next manifest. A compaction
that died before its manifest leaves nothing that a reader sees. `retire` deletes what is no longer live.
Files that loads append become live with the next manifest.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.sources.folders import drop, names, qualified
from ledgerlake.sources.workspace import written

BITS = 6


def curve(columns: Sequence[str], bounds: Sequence[Sequence]) -> Column:
    """A place on the Z curve: the bits of each column's quantile, in turn. NULL comes first."""
    number = F.lit(0).cast("long")
    for i, (name, cuts) in enumerate(zip(columns, bounds)):
        if not cuts:
            continue
        below = F.filter(F.array(*[F.lit(cut) for cut in cuts]), lambda cut: F.col(name) > cut)
        rank = F.size(below).cast("long")
        for bit in range(BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            number = number + F.shiftleft(one, bit * len(columns) + i)
    return number


def _quantiles(df: DataFrame, columns: Sequence[str]) -> list[list]:
    steps = [i / 2**BITS for i in range(1, 2**BITS)]
    row = df.agg(*[F.percentile_approx(c, steps, 1_000).alias(c) for c in columns]).first()
    return [row[c] or [] for c in columns]


def file_name() -> Column:
    """The file of a row, as a path: the metadata has it as an address, with its percent signs."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _described(files: DataFrame, order_by: Sequence[str], partition_by: Sequence[str], base: str) -> DataFrame:
    """One row per file: name, size, rows, partition and the range of each ordering column."""
    ranges = [f(c).alias(f"{n}_{c}") for c in order_by for n, f in (("least", F.min), ("greatest", F.max))]
    part = F.to_json(F.struct(*partition_by), {"ignoreNullFields": "false"}) if partition_by else F.lit("")
    return (files.groupBy(file_name().alias("file"), F.col("_metadata.file_size").alias("size"),
                          part.alias("part"))
            .agg(F.count(F.lit(1)).alias("rows"), *ranges).withColumns({"base": F.lit(base), "live": F.lit(True)}))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """The manifests that are there; each is one file, so it is there as a whole or not at all."""
    return sorted(int(n) for n in names(spark, f"{root}/manifests")
                  if any(f.endswith(".parquet") for f in names(spark, f"{root}/manifests/{n}")))


def _entries(spark: SparkSession, root: str) -> DataFrame:
    """The newest manifest: the live files, and those that no longer are but have not been deleted."""
    return spark.read.parquet(f"{root}/manifests/{max(_numbers(spark, root))}")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The live files of the newest manifest."""
    return _entries(spark, root).filter("live")


def _publish(entries: DataFrame, root: str, number: int) -> None:
    entries.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/{number}")


def _schema(spark: SparkSession, root: str) -> StructType:
    """The schema of `data`, or of a compaction where all of `data` was rewritten."""
    base = manifest(spark, root).agg(F.max("base")).first()[0] if _numbers(spark, root) else None
    return spark.read.parquet(f"{root}/{base or 'data'}").schema


def _place(file: str) -> str:
    """A path without its scheme, which Spark writes with one slash here and three there."""
    return file.split(":", 1)[1].lstrip("/")


def _listed(spark: SparkSession, root: str, order_by: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """What the newest manifest names, and the files of `data` that came since."""
    data = spark.read.schema(_schema(spark, root)).parquet(f"{root}/data")
    if not _numbers(spark, root):
        return _described(data, order_by, partition_by, "data")
    known = _entries(spark, root)
    old = {_place(r.file) for r in known.select("file").collect()}
    new = sorted(f for f in map(unquote, data.inputFiles()) if _place(f) not in old)
    if not new:
        return known
    fresh = spark.read.schema(data.schema).option("basePath", f"{root}/data").parquet(*new)
    return known.unionByName(_described(fresh, order_by, partition_by, "data").select(*known.columns))


def _read(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The rows of some files; their names pass through the driver, as those of any scan do."""
    per_base: dict[str, list[str]] = {}
    for r in files.select("base", "file").collect():
        per_base.setdefault(r.base, []).append(r.file)
    schema = _schema(spark, root)
    frames = [spark.read.schema(schema).option("basePath", f"{root}/{base}").parquet(*sorted(per_base[base]))
              for base in sorted(per_base)]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def read_live(spark: SparkSession, root: str, ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    """The table by its newest manifest; with `ranges` (column: least, greatest) only the rows in all of them.

    Files whose values all lie outside are not opened.
    """
    root = qualified(spark, root)
    files, keep = manifest(spark, root), F.lit(True)
    for name, (low, high) in (ranges or {}).items():
        files = files.filter((F.col(f"greatest_{name}") >= F.lit(low)) & (F.col(f"least_{name}") <= F.lit(high)))
        keep = keep & F.col(name).between(F.lit(low), F.lit(high))
    rows = _read(spark, root, files)
    return rows.filter(keep) if ranges else rows


def compact_small(
    spark: SparkSession, root: str, order_by: Sequence[str], partition_by: Sequence[str] = (),
    small: int = 32 << 20, target: int = 128 << 20,
) -> int:
    """Rewrite the files under `small` bytes of partitions that have several, in files of about `target` bytes.

    Returns the number of the new manifest. One compaction of a table runs at a time.
    """
    root = qualified(spark, root)
    number = max(_numbers(spark, root), default=0) + 1
    files = written(_listed(spark, root, order_by, partition_by), "files")
    little = files.filter(F.col("live") & (F.col("size") < small))
    several = little.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("part")
    chosen = written(little.join(several, "part", "left_semi"), "chosen")
    size = chosen.agg(F.sum("size")).first()[0]
    entries = files
    if size:
        rows, base = _read(spark, root, chosen), f"compacted/{number}"
        place = curve(order_by, _quantiles(rows, order_by))
        writer = (rows.withColumn("_place", place)
                  .repartitionByRange(math.ceil(size / target), *partition_by, "_place")
                  .sortWithinPartitions(*partition_by, "_place").drop("_place").write.mode("overwrite"))
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{base}")
        out = spark.read.schema(rows.schema).parquet(f"{root}/{base}")
        again = chosen.select("file", F.lit(True).alias("rewritten"))
        entries = (files.join(again, "file", "left").withColumn("live", F.expr("live AND rewritten IS NULL"))
                   .select(*files.columns).unionByName(
                       written(_described(out, order_by, partition_by, base), "described")))
    _publish(entries, root, number)
    return number


def retire(spark: SparkSession, root: str) -> int:
    """Delete the files that are no longer live, for when no reader uses them any more; returns their number."""
    root = qualified(spark, root)
    gone = _entries(spark, root).filter("NOT live").select("file").collect()
    for r in gone:
        drop(spark, r.file)
    _publish(manifest(spark, root), root, max(_numbers(spark, root)) + 1)
    return len(gone)
