"""Family reports: members, merger timeline, member and network trends, headline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.semantics import latest_month, month_between, ratio, trailing_months
from skyledger.operators.rolling import roll12

MEMBERS = "listagg(carrier, ' + ') WITHIN GROUP (ORDER BY merged_month ASC NULLS FIRST, carrier)"


def family_summary(families: DataFrame, family_month: DataFrame) -> DataFrame:
    """Families with their members in merger order and the last twelve months' seats they rank by.

    The window ends with the table's last month. A family without traffic keeps NULL seats.
    """
    recent = family_month.filter(F.col("flight_month") >= F.add_months(latest_month(family_month), -11))
    seats = recent.groupBy("family").agg(F.sum("seats").alias("seats_12m"))
    members = families.groupBy("family").agg(F.max("family_name").alias("family_name"), F.expr(MEMBERS).alias("members"))
    return members.join(seats, "family", "left").orderBy(F.col("seats_12m").desc_nulls_last(), "family")


def merger_timeline(families: DataFrame) -> DataFrame:
    """Members in merger order, survivors first."""
    return families.select("family", "carrier", "merged_month", "note").orderBy(
        "family", F.col("merged_month").asc_nulls_first(), "carrier"
    )


def members_flown(families: DataFrame, carrier_month: DataFrame) -> DataFrame:
    """The merger timeline next to the traffic: first and last month and seats of every member code, if it ever flew."""
    flown = carrier_month.groupBy("carrier").agg(
        F.min("flight_month").alias("first_month"), F.max("flight_month").alias("last_month"), F.sum("seats").alias("seats")
    )
    return merger_timeline(families).join(flown, "carrier", "left")


def merger_markers(families: DataFrame, start=None, end=None) -> DataFrame:
    """One marker per family and merger month inside the window, naming the codes that merged."""
    return (
        families.filter(F.col("merged_month").isNotNull() & month_between("merged_month", start, end))
        .groupBy("family", "merged_month")
        .agg(F.expr("listagg(carrier, '/') WITHIN GROUP (ORDER BY carrier)").alias("carriers"))
    )


def family_members_trend(
    carrier_month: DataFrame, families: DataFrame, smooth: bool = True, start=None, end=None
) -> DataFrame:
    """Seats of every member code in millions; smoothed series start at their twelfth month."""
    members = families.select("carrier", "family")
    series = carrier_month.join(members, "carrier", "inner").select(
        "family", "carrier", "carrier_name", "flight_month", "seats"
    )
    value = F.col("seats")
    if smooth:
        series = roll12(series, ["carrier"], "seats").filter(F.col("seats_12m").isNotNull())
        value = F.col("seats_12m")
    return series.filter(month_between("flight_month", start, end)).select(
        "family", "carrier", "carrier_name", "flight_month", (value / F.lit(1e6)).alias("seats_millions")
    )


def family_network_trend(family_month: DataFrame, smooth: bool = True, start=None, end=None) -> DataFrame:
    """Directional routes served and airports served by each family."""
    series = family_month.select("family", "flight_month", "routes_served", "airports_served")
    if smooth:
        series = roll12(series, ["family"], "routes_served").filter(F.col("routes_served_12m").isNotNull())
    return series.filter(month_between("flight_month", start, end))


def family_headline(family_month: DataFrame, carrier_month: DataFrame, families: DataFrame) -> DataFrame:
    """Member codes, codes still flying, and the family's last twelve months."""
    mapped = family_month.join(families.select("family").distinct(), "family", "left_semi")
    ends = mapped.groupBy("family").agg(F.max("flight_month").alias("latest"))
    in_year = mapped.join(ends, "family").filter(trailing_months("flight_month", F.col("latest"), 12))
    year = (
        in_year.groupBy("family", "latest")
        .agg(
            F.sum("seats").alias("seats_12m"),
            F.sum("passengers").alias("pax_12m"),
            F.max_by("routes_served", "flight_month").alias("routes_now"),
        )
        .withColumn("load_factor_12m", ratio("pax_12m", "seats_12m"))
    )
    flying = (
        carrier_month.join(families.select("carrier", "family"), "carrier")
        .join(ends, "family")
        .filter(F.col("flight_month") == F.col("latest"))
        .groupBy("family")
        .agg(F.count("carrier").alias("still_flying"))
    )
    codes = families.groupBy("family").agg(F.count("carrier").alias("member_codes"))
    return (
        codes.join(year, "family", "left")
        .join(flying, "family", "left")
        .withColumn("still_flying", F.coalesce("still_flying", F.lit(0)))
        .drop("pax_12m")
    )
