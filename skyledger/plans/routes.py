"""Route reports: monthly series, headline, load factor, capacity and share gap of every route at once.

``routes`` is the gold route x carrier table. With ``families`` the carriers are merged into
families. A route is directed, or with ``both`` the undirected pair (a <= b) with the return leg.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.semantics import clip_low, month_between, ratio, trailing_months
from skyledger.operators.family import with_key
from skyledger.operators.periods import with_latest
from skyledger.operators.rolling import roll12

PAIR = ["a", "b"]


def route_monthly(
    routes: DataFrame, families: DataFrame | None = None, both: bool = True, carriers: list[str] | None = None,
    start=None, end=None,
) -> DataFrame:
    """Month x carrier or family x directed route, with the route key ``a, b``."""
    keyed = with_key(routes.filter(month_between("flight_month", start, end)), families)
    if carriers is not None:
        keyed = keyed.filter(F.col("key").isin(carriers))
    ends = {"origin_lat": "o_lat", "origin_lon": "o_lon", "dest_lat": "d_lat", "dest_lon": "d_lon"}
    if families is None:  # the gold grain already is this one
        rows = keyed.select(
            "flight_month", F.col("key").alias("carrier"), F.col("key_name").alias("carrier_name"), "origin", "dest",
            "seats", "passengers", "distance_miles", *[F.col(c).alias(a) for c, a in ends.items()],
        )
    else:
        rows = keyed.groupBy("flight_month", F.col("key").alias("carrier"), "origin", "dest").agg(
            F.max("key_name").alias("carrier_name"),
            F.sum("seats").alias("seats"),
            F.sum("passengers").alias("passengers"),
            F.max("distance_miles").alias("distance_miles"),
            *[F.max(c).alias(a) for c, a in ends.items()],
        )
    if both:
        return rows.withColumns({"a": F.least("origin", "dest"), "b": F.greatest("origin", "dest")})
    return rows.withColumns({"a": F.col("origin"), "b": F.col("dest")})


def route_headline(monthly: DataFrame) -> DataFrame:
    """Distance, carriers, and the last twelve months' passengers and load factor of each route."""
    recent = trailing_months("flight_month", F.col("_end"), 12)
    return (
        with_latest(monthly, PAIR)
        .groupBy(*PAIR)
        .agg(
            F.max("distance_miles").alias("distance_miles"),
            F.count_distinct("carrier").alias("carriers"),
            F.coalesce(F.sum(F.when(recent, F.col("passengers"))), F.lit(0)).alias("passengers_12m"),
            F.coalesce(F.sum(F.when(recent, F.col("seats"))), F.lit(0)).alias("_seats"),
        )
        .withColumn("load_factor_12m", ratio("passengers_12m", clip_low("_seats")))
        .drop("_seats")
    )


def _per_carrier(monthly: DataFrame) -> DataFrame:
    return (
        monthly.filter(F.col("carrier_name").isNotNull())
        .groupBy(*PAIR, "flight_month", "carrier_name")
        .agg(F.sum("seats").alias("seats"), F.sum("passengers").alias("passengers"))
    )


def _combined(per_carrier: DataFrame) -> DataFrame:
    return per_carrier.groupBy(*PAIR, "flight_month").agg(
        F.sum("seats").alias("seats"), F.sum("passengers").alias("passengers")
    )


def route_load_factor(monthly: DataFrame, smooth: bool = False) -> DataFrame:
    """Load factor series per carrier name and for "All selected", recomputed from sums at both levels."""
    each = _per_carrier(monthly)
    total = _combined(each).withColumn("carrier_name", F.lit("All selected"))
    series = each.unionByName(total).withColumn("load_factor", ratio("passengers", "seats"))
    return roll12(series, [*PAIR, "carrier_name"], "load_factor") if smooth else series


def route_capacity_demand(monthly: DataFrame, smooth: bool = False) -> DataFrame:
    """Long series of seats and passengers over all selected carriers."""
    long = _combined(_per_carrier(monthly)).unpivot(
        [*PAIR, "flight_month"], ["seats", "passengers"], "measure", "count"
    )
    return roll12(long, [*PAIR, "measure"], "count") if smooth else long


def share_gap(monthly: DataFrame) -> DataFrame:
    """Each carrier's slice of the route's seats and passengers, and how far it is from the route's load factor."""
    per = (
        monthly.filter(F.col("carrier_name").isNotNull())
        .groupBy(*PAIR, "carrier", "carrier_name")
        .agg(F.sum("seats").alias("seats"), F.sum("passengers").alias("passengers"))
        .filter(F.col("seats") > 0)
    )
    route = Window.partitionBy(*PAIR)
    return (
        per.withColumns({"_seats": F.sum("seats").over(route), "_pax": F.sum("passengers").over(route)})
        .withColumns(
            {
                "seat_share": ratio("seats", "_seats"),
                "pax_share": ratio("passengers", "_pax"),
                "load_factor": ratio("passengers", "seats"),
            }
        )
        .withColumns(
            {
                "lf_gap_pp": F.col("load_factor") - ratio("_pax", "_seats"),
                "share_gap_pp": F.col("pax_share") - F.col("seat_share"),
            }
        )
        .drop("_seats", "_pax")
    )
