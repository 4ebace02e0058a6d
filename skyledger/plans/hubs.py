"""Hub reports. ``key`` is the carrier column of the table in hand: ``carrier`` or ``family``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.semantics import month_between, year_bounds
from skyledger.operators.family import with_key
from skyledger.operators.periods import with_latest
from skyledger.operators.ranking import top_k
from skyledger.operators.rolling import roll12, smooth_then_window


def top_carriers(system: DataFrame, ref_year: int, n: int, key: str = "carrier", name: str = "carrier_name") -> DataFrame:
    """The ``n`` largest carriers or families of a year by seats."""
    return (
        system.filter(month_between("flight_month", *year_bounds(ref_year)))
        .groupBy(key)
        .agg(F.max(name).alias(name), F.sum("seats").alias("seats"), F.sum("passengers").alias("passengers"))
        .orderBy(F.col("seats").desc_nulls_last(), key)
        .limit(n)
    )


def majors_trend(system: DataFrame, ref_year: int, n: int = 8) -> DataFrame:
    """Monthly seats of the year's majors over all years, smoothed."""
    majors = top_carriers(system, ref_year, n).select("carrier")
    series = system.join(majors, "carrier", "left_semi").select("flight_month", "carrier", "carrier_name", "seats")
    return roll12(series, ["carrier"], "seats")


def top_hubs(airports: DataFrame, ref_year: int, n: int = 6, key: str = "carrier") -> DataFrame:
    """Each carrier's ``n`` largest airports of a year."""
    year = (
        airports.filter(month_between("flight_month", *year_bounds(ref_year)))
        .groupBy(key, "airport")
        .agg(F.sum("seats").alias("seats"))
    )
    return top_k(year, [key], "seats", ["airport"], n)


def hub_trend(
    airports: DataFrame, ref_year: int, n: int = 6, key: str = "carrier", share: str = "pct_of_carrier_system",
    smooth: bool = True, start=None, end=None,
) -> DataFrame:
    """System share and airport share over time at each carrier's hubs of the reference year."""
    hubs = top_hubs(airports, ref_year, n, key).select(key, "airport")
    series = airports.join(hubs, [key, "airport"], "left_semi").select(
        "flight_month", key, "airport",
        F.col(share).alias("system_share"), F.col("pct_of_airport_seats").alias("airport_share"),
    )
    if smooth:
        return smooth_then_window(series, [key, "airport"], ["system_share", "airport_share"], start, end)
    return series.filter(month_between("flight_month", start, end))


def spokes(routes: DataFrame, families: DataFrame | None = None, month=None) -> DataFrame:
    """Located nonstops out of every hub in one month: the given one, or each hub's last served."""
    keyed = with_key(routes, families).drop("carrier")
    picked = with_latest(keyed, ["key", "origin"], month)
    return (
        picked.filter((F.col("flight_month") == F.col("_end")) & F.col("dest_lat").isNotNull())
        .groupBy(F.col("key").alias("carrier"), F.col("origin").alias("hub"), "flight_month", "dest")
        .agg(
            F.max("dest_city").alias("dest_city"),
            F.max("dest_lat").alias("d_lat"),
            F.max("dest_lon").alias("d_lon"),
            F.max("origin_lat").alias("o_lat"),
            F.max("origin_lon").alias("o_lon"),
            F.sum("seats").alias("seats"),
            F.sum("passengers").alias("passengers"),
        )
    )


def in_pairs(df: DataFrame, pairs: list[tuple[str, str]], columns: tuple[str, str]) -> DataFrame:
    """Rows whose two columns form one of the listed pairs; the list is a local relation."""
    firsts, seconds = zip(*pairs)
    listed = df.sparkSession.createDataFrame(pa.table({columns[0]: list(firsts), columns[1]: list(seconds)}))
    return df.join(listed.distinct(), list(columns), "left_semi")


def fortress_pairs(airports: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Smoothed share of airport seats for chosen (airport, carrier) pairs."""
    series = in_pairs(airports, pairs, ("airport", "carrier")).select(
        "flight_month", "airport", "carrier", F.col("pct_of_airport_seats").alias("pct")
    )
    return roll12(series, ["airport", "carrier"], "pct")


def dehub(airports: DataFrame, codes: list[str]) -> DataFrame:
    """All carriers' seats at the chosen airports, smoothed."""
    series = airports.filter(F.col("airport").isin(codes)).groupBy("flight_month", "airport").agg(F.sum("seats").alias("seats"))
    return roll12(series, ["airport"], "seats")


def served_months(system: DataFrame, per: list[str] | None = None) -> DataFrame:
    """Months with any service, over all rows or for every key."""
    return system.select(*(per or []), "flight_month").distinct()
