"""File layout of a table, and compaction of small files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.columns import mebibytes


def layout_report(files: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Files, sizes in MiB, rows and partition columns of a file-based table, as one row.

    `files` is a plain scan: it is grouped by the hidden file metadata, so only file names and
    sizes are read beside the row counts.
    """
    per_file = files.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
    ).agg(F.count(F.lit(1)).alias("n"))
    size = mebibytes(F.col("size"))
    return per_file.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum(size).alias("total_mib"), F.avg(size).alias("avg_mib"),
        F.median(size).alias("median_mib"), F.min(size).alias("min_mib"),
        F.max(size).alias("max_mib"),
        F.sum("n").alias("row_count"), F.avg("n").alias("rows_per_file"),
    ).select(F.lit(name).alias("table_name"),
             F.lit(", ".join(partition_by)).alias("partition_columns"), "*")


def compact(
    spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = (),
    fmt: str = "parquet", max_rows_per_file: int = 0,
) -> None:
    """Rewrite a table with files near the advisory size into another folder.

    The source stays as it is; readers switch over when the copy is complete.
    """
    df = spark.read.format(fmt).load(source).hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
