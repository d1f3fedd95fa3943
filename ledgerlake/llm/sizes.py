"""Broadcasts behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.sources.workspace import written

#: A side of more rows is joined by a shuffle. Sides are narrow: a few dozen bytes a row.
BROADCAST_ROWS = 250_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, to be broadcast if it has at most `rows` rows, else joined by a shuffle."""
    stored = written(df, "side")
    return F.broadcast(stored) if stored.count() <= rows else stored
