"""Registering existing tables in the session catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


class CatalogError(RuntimeError):
    """A registered table does not hold what it should."""


@dataclass(frozen=True)
class Registration:
    name: str
    location: str
    row_count: int
    registered_now: bool


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db){' LOCATION :at' if location else ''}",
              args={"db": database, **({"at": location} if location else {})})


def register_table(
    spark: SparkSession, database: str, table: str, location: str, fmt: str = "parquet",
) -> bool:
    """Point a catalog name at existing files. False when the name is taken already."""
    name = f"{database}.{table}"
    if spark.catalog.tableExists(name):
        return False
    spark.catalog.createTable(name, path=location, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(name)) and fmt != "delta":
        spark.catalog.recoverPartitions(name)
    return True


def count_rows(spark: SparkSession, database: str, table: str) -> int:
    return spark.table(f"{database}.{table}").agg(F.count(F.lit(1))).first()[0]


def register_verified(
    spark: SparkSession, database: str, table: str, location: str, fmt: str = "parquet",
    expected_rows: int | None = None, database_location: str | None = None,
) -> Registration:
    """Register if needed, then count through the catalog and compare with `expected_rows`."""
    ensure_database(spark, database, database_location)
    now = register_table(spark, database, table, location, fmt)
    spark.catalog.refreshTable(f"{database}.{table}")
    rows = count_rows(spark, database, table)
    if expected_rows is not None and rows != expected_rows:
        raise CatalogError(f"{database}.{table}: expected {expected_rows} rows, found {rows}")
    return Registration(f"{database}.{table}", location, rows, now)
