"""Top-k per key, best/worst splits and the long-tail bucket.

Each runs after aggregation to dimension grain: a group holds at most one row per airport,
carrier or pair of them, whatever the number of raw rows behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: list[str], measure: str, ties: list[str], k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` largest rows of each group, equal measures ordered by ``ties``.

    Spark cuts each map task's groups to ``k`` rows before the shuffle.
    """
    w = Window.partitionBy(*by).orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def head_tail(
    df: DataFrame, by: list[str], measure: str, ties: list[str], n_each: int, low: str, high: str
) -> DataFrame:
    """The ``n_each`` lowest and highest rows of each group, labelled in ``side``.

    A group of at most ``2 * n_each`` rows is split in half instead (the middle row goes to the
    high side), and a group with a single row is left out.
    """
    keys = Window.partitionBy(*by)
    ordered = keys.orderBy(F.col(measure).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    pos, n = F.col("_pos"), F.col("_n")
    half = F.greatest(F.lit(1), F.floor(n / 2))
    small = n <= 2 * n_each
    side = (
        F.when(small & (pos <= half), low)
        .when(small, high)
        .when(pos <= n_each, low)
        .when(pos > n - n_each, high)
    )
    return (
        df.withColumns({"_pos": F.row_number().over(ordered), "_n": F.count(F.lit(1)).over(keys)})
        .filter(n >= 2)
        .withColumn("side", side)
        .filter(F.col("side").isNotNull())
        .drop("_pos", "_n")
    )


def lump_other(df: DataFrame, named: DataFrame, on: list[str], column: str) -> DataFrame:
    """Values of ``column`` that are not in ``named`` become "Other"."""
    marked = named.select(*on, column).distinct().withColumn("_named", F.lit(True))
    kept: Column = F.when(F.col("_named"), F.col(column)).otherwise(F.lit("Other"))
    return df.join(marked, [*on, column], "left").withColumn(column, kept).drop("_named")
