"""Whole rows as one column, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """A column by its plain name, which may hold spaces, dots, dashes and backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    return F.struct(*[named(c) for c in df.columns])
