"""Comparisons of the last twelve months with the twelve before, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_latest(df: DataFrame, by: list[str], as_of=None, name: str = "_end") -> DataFrame:
    """Attach the reference month: ``as_of`` when given, else each key's own last month.

    The maxima are pre-aggregated on the map side and joined back, so a key with very many
    rows is never gathered in one task.
    """
    if as_of is not None:
        return df.withColumn(name, F.lit(as_of).cast("date"))
    return df.join(df.groupBy(*by).agg(F.max("flight_month").alias(name)), by, "inner")


def with_period(df: DataFrame, end: str = "_end") -> DataFrame:
    """Keep the 24 months up to ``end`` and label them 'latest' and 'prior'."""
    month, last = F.col("flight_month"), F.col(end)
    period = F.when(month > F.add_months(last, -12), "latest").otherwise("prior")
    return df.filter((month > F.add_months(last, -24)) & (month <= last)).withColumn("period", period)


def sum_in(period: str, c: str) -> Column:
    """One cell of the latest/prior pivot; a missing period is zero."""
    return F.coalesce(F.sum(F.when(F.col("period") == period, F.col(c))), F.lit(0))


def pivot_periods(df: DataFrame, keys: list[str], measures: list[str], months: bool = False) -> DataFrame:
    """Wide latest/prior totals per key: fixed columns and one shuffle, no pivot pass.

    ``months`` counts the rows of each period, which are months when the input has one row per
    key and month. Keys holding a NULL are dropped.
    """
    cells = [sum_in(p, m).alias(f"{m}_{p}") for m in measures for p in ("latest", "prior")]
    if months:
        cells += [F.count_if(F.col("period") == p).alias(f"months_{p}") for p in ("latest", "prior")]
    return df.na.drop(subset=keys).groupBy(*keys).agg(*cells)
