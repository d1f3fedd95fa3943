"""Table scans, typed Bronze ingest and verified writes."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import TABLES, Lakehouse
from ledgerlake.functions.columns import cast_columns
from ledgerlake.sources.catalog import register_verified

log = logging.getLogger(__name__)


class IngestError(RuntimeError):
    """A source table breaks its contract or a write does not read back whole."""


# --- Reading ----------------------------------------------------------------------------------


def read_table(
    spark: SparkSession, lake: Lakehouse, zone: str, table: str, merge_schema: bool = False,
) -> DataFrame:
    """Scan one table of a zone.

    `merge_schema` shows columns that only some Parquet files have; it opens every footer first,
    so ask for it only after a schema change.
    """
    reader = spark.read.format(lake.fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(lake.path(zone, table))


def read_present(df: DataFrame, column: str) -> DataFrame:
    """One column without its NULLs; both the pruning and the filter reach the Parquet scan."""
    return df.select(column).filter(F.col(column).isNotNull())


# --- Bronze contract --------------------------------------------------------------------------


def require_columns(df: DataFrame, table: str) -> None:
    missing = sorted(TABLES[table].kinds().keys() - set(df.columns))
    if missing:
        raise IngestError(f"table '{table}' lacks expected columns: {', '.join(missing)}")


def normalize_bronze(df: DataFrame, table: str) -> DataFrame:
    """The rows as they came, with declared columns in their declared types.

    Bronze promises that what a source sent can be read back: rows and values are all there, and a
    value that its type cannot hold stops the load instead of turning into NULL.
    """
    require_columns(df, table)
    return cast_columns(df, TABLES[table].kinds(), strict=True)


# --- Writing ----------------------------------------------------------------------------------


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a table, partitioned if asked.

    REBALANCE lets AQE shape the output: rows of one partition value go to one file until the
    advisory size, a value with too many rows is split over several tasks, small ones share a task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


@dataclass(frozen=True)
class WriteResult:
    table: str
    source_rows: int
    target_rows: int


def write_verified(
    df: DataFrame, table: str, path: str, fmt: str = "parquet", mode: str = "overwrite",
) -> WriteResult:
    """Write, read the row count back, and fail if an overwrite does not hold exactly its source.

    Both counts are queries of their own: they need no column, so on Parquet they read footers,
    and unlike counters kept during the write they stay exact when tasks are run again.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    source_rows = df.count()
    write_table(df, path, fmt=fmt, mode=mode)
    target_rows = df.sparkSession.read.format(fmt).load(path).count()
    if mode == "overwrite" and target_rows != source_rows:
        raise IngestError(f"table '{table}': wrote {source_rows} rows, found {target_rows}")
    return WriteResult(table, source_rows, target_rows)


# --- Ingest -----------------------------------------------------------------------------------


def selected_tables(names: Iterable[str] | None) -> list[str]:
    """The tables to load: all, or those asked for, each once and in that order."""
    chosen: dict[str, bool] = {}
    for name in TABLES if names is None else names:
        chosen.setdefault(name, name in TABLES)
    if not all(chosen.values()):
        raise IngestError("unknown tables: " + ", ".join(sorted(n for n, ok in chosen.items() if not ok))
                          + "; known are " + ", ".join(TABLES))
    return list(chosen)


SUMMARY = ("table_name string, source_rows long, target_rows long, catalog_rows long,"
           " registered_now boolean, seconds double, error string")


def ingest(
    spark: SparkSession, lake: Lakehouse, source: Callable[[str], DataFrame],
    tables: Iterable[str] | None = None, mode: str = "overwrite",
    continue_on_error: bool = False, database: str | None = None,
) -> DataFrame:
    """Load tables into Bronze: check columns, cast, write, verify, optionally register.

    Returns one summary row per attempted table. The first failure ends the run unless
    `continue_on_error` is set; the failure is in the summary either way.
    """
    rows = []
    for table in selected_tables(tables):
        started = time.perf_counter()
        try:
            df = normalize_bronze(source(table), table)
            path = lake.path("bronze", table)
            done = write_verified(df, table, path, lake.fmt, mode)
            entry = (register_verified(spark, database, table, path, lake.fmt, done.target_rows)
                     if database else None)
            rows.append((table, done.source_rows, done.target_rows,
                         entry.row_count if entry else None,
                         entry.registered_now if entry else None,
                         time.perf_counter() - started, None))
        except Exception as problem:
            log.exception("ingest of %s failed", table)
            rows.append((table, None, None, None, None,
                         time.perf_counter() - started, str(problem)))
            if not continue_on_error:
                break
    return spark.createDataFrame(rows, SUMMARY)


def ingest_all(
    spark: SparkSession, lake: Lakehouse, source: Callable[[str], DataFrame],
    mode: str = "overwrite",
) -> list[WriteResult]:
    """Load every table; the first failure is raised at once."""
    return [
        write_verified(normalize_bronze(source(t), t), t, lake.path("bronze", t), lake.fmt, mode)
        for t in TABLES]


def zone(spark: SparkSession, lake: Lakehouse, name: str, tables: Iterable[str],
         ) -> Mapping[str, DataFrame]:
    return {t: read_table(spark, lake, name, t) for t in tables}
