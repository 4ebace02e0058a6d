"""Rolling means over the rows, or the calendar months, of a monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.semantics import month_between


def roll12(df: DataFrame, by: list[str], *columns: str, rows: int = 12, order: str = "flight_month") -> DataFrame:
    """Add ``<column>_12m``: the mean of the last twelve rows of the group.

    It counts rows, not calendar months, and stays NULL until twelve values are present. All
    columns share one window, hence one shuffle and one sort; a group holds one row per month.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumns(
        {f"{c}_12m": F.when(F.count(c).over(w) == rows, F.avg(c).over(w)) for c in columns}
    )


def roll_months(df: DataFrame, by: list[str], *columns: str, months: int = 12, least: int = 12, order: str = "flight_month") -> DataFrame:
    """Add ``<column>_<months>mo``: the mean of the values of the last ``months`` calendar months, where at least ``least`` are present.

    Unlike ``roll12`` a missing month leaves its place empty instead of stretching the span.
    """
    index = F.year(order) * 12 + F.month(order)
    w = Window.partitionBy(*by).orderBy(index).rangeBetween(1 - months, 0)
    return df.withColumns({f"{c}_{months}mo": F.when(F.count(c).over(w) >= least, F.avg(c).over(w)) for c in columns})


def smooth_then_window(df: DataFrame, by: list[str], columns: list[str], start=None, end=None) -> DataFrame:
    """Smooth over the full history, then keep the months shown, so the first ones have a real mean."""
    return roll12(df, by, *columns).filter(month_between("flight_month", start, end))
