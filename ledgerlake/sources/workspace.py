"""The shared folder for written intermediate results.

A cluster names it in `spark.checkpoint.dir`. Only a local session without that setting gets a
folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerlake-{application}-")


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or context.getConf().get("spark.checkpoint.dir", None)
             or context.getCheckpointDir())
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(context.applicationId)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/ledgerlake/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
