"""Bronze to Silver."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake import config
from ledgerlake.operators.clean import CLEANERS
from ledgerlake.operators.quality import transaction_gate
from ledgerlake.sources.tables import read_table, selected_tables, write_table
from ledgerlake.sources.workspace import written

log = logging.getLogger(__name__)

QUALITY = "table_name string, bronze_rows long, silver_rows long, removed_rows long"


def run_silver(
    spark: SparkSession, lake: config.Lakehouse, names: Iterable[str] | None = None,
) -> DataFrame:
    """Clean and write the tables; returns bronze, silver and removed rows per table.

    Rows in and out are counted on the stored tables, which reads footers only. Transactions pass
    their gate before anything is written: a failing load leaves the old table in place.
    """
    counts = []
    for table in selected_tables(names):
        bronze = read_table(spark, lake, "bronze", table)
        silver = CLEANERS[table](bronze)
        if table == "transactions":
            # cleaned once: the gate reads the stored rows, and those are published
            silver = written(silver, "staged")
            transaction_gate(silver)
        write_table(silver, lake.path("silver", table), lake.fmt,
                    config.TABLES[table].partition_by)
        rows_in, rows_out = bronze.count(), read_table(spark, lake, "silver", table).count()
        counts.append((table, rows_in, rows_out, rows_in - rows_out))
        log.info("%s: bronze %d, silver %d, removed %d", *counts[-1])
    return spark.createDataFrame(counts, QUALITY)
