"""Joins whose small side is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; for a table read from files, the size of those files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_files_small(df: DataFrame, source: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` when the files of ``source``, whose rows it keeps one to one, are small.

    A join's own estimate is the product of its inputs, which hides a small side and may even
    make Spark broadcast the fact table instead.
    """
    return F.broadcast(df) if plan_bytes(source) <= limit else df


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger side is left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
