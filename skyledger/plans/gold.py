"""Gold aggregates: scheduled passenger service, counted on the departure side.

The five tables roll up one another: fact -> route x carrier -> airport x carrier -> carrier.
Each level is already unique on its grain, so a distinct count of the level below is a plain
count and no row is ever expanded for COUNT(DISTINCT). Only the first level sees raw volume,
and it is pre-aggregated before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.semantics import load_factor_pct, pct
from skyledger.operators.family import with_key
from skyledger.operators.grouping import sum_with_labels

ROUTE_LABELS = ["origin_city", "origin_state", "origin_country", "dest_city", "dest_country"]
ROUTE_NUMBERS = ["origin_lat", "origin_lon", "dest_lat", "dest_lon", "distance_miles"]
AIRPORT_ATTRIBUTES = {
    "origin_city": "city",
    "origin_state": "state",
    "origin_country": "country",
    "origin_lat": "latitude",
    "origin_lon": "longitude",
}
MEASURES = ["departures", "seats", "passengers"]


def scheduled_passenger(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("service_class") == "F")


def route_level(fact: DataFrame) -> DataFrame:
    """One row per month, carrier and directed route, with every attribute a higher level needs."""
    rows = scheduled_passenger(fact).withColumn("departures", F.col("departures_performed"))
    keys = ["flight_month", "carrier", "origin", "dest"]
    return sum_with_labels(rows, keys, ["carrier_name", *ROUTE_LABELS], MEASURES, ROUTE_NUMBERS)


def family_route_level(routes: DataFrame, families: DataFrame) -> DataFrame:
    """The route level re-keyed by family: several members of one family may fly one route."""
    keys = ["flight_month", "key", "origin", "dest"]
    return sum_with_labels(with_key(routes, families), keys, ["key_name", *ROUTE_LABELS], MEASURES, ROUTE_NUMBERS)


def _airport_level(routes: DataFrame, key: str, name: str) -> DataFrame:
    return routes.groupBy("flight_month", F.col("origin").alias("airport"), key).agg(
        F.max(name).alias(name),
        *[F.max(c).alias(a) for c, a in AIRPORT_ATTRIBUTES.items()],
        *[F.sum(m).alias(m) for m in MEASURES],
        F.count("dest").alias("nonstop_dests"),
    )


def _with_shares(airports: DataFrame, key: str, system_share: str) -> DataFrame:
    """Share of the key's monthly system and of the airport's month, against summed denominators."""
    totals = {
        "_system": F.sum("seats").over(Window.partitionBy("flight_month", key)),
        "_field": F.sum("seats").over(Window.partitionBy("flight_month", "airport")),
    }
    return (
        airports.withColumns(totals)
        .withColumns(
            {
                "load_factor_pct": load_factor_pct("passengers", "seats"),
                system_share: pct("seats", "_system", 2),
                "pct_of_airport_seats": pct("seats", "_field", 2),
            }
        )
        .drop(*totals)
    )


def _system_level(airports: DataFrame, key: str, name: str) -> DataFrame:
    return (
        airports.groupBy("flight_month", key)
        .agg(
            F.max(name).alias(name),
            *[F.sum(m).alias(m) for m in MEASURES],
            F.count("airport").alias("airports_served"),
            F.coalesce(F.sum(F.when(F.col("airport").isNotNull(), F.col("nonstop_dests"))), F.lit(0)).alias("routes_served"),
        )
        .withColumn("load_factor_pct", load_factor_pct("passengers", "seats"))
        .select("flight_month", key, name, *MEASURES, "load_factor_pct", "airports_served", "routes_served")
    )


def route_carrier_month_of(routes: DataFrame) -> DataFrame:
    return routes.withColumn("load_factor_pct", load_factor_pct("passengers", "seats")).select(
        "flight_month", "carrier", "carrier_name",
        "origin", "origin_city", "origin_country", "origin_lat", "origin_lon",
        "dest", "dest_city", "dest_country", "dest_lat", "dest_lon",
        "distance_miles", *MEASURES, "load_factor_pct",
    )


def airport_carrier_month_of(routes: DataFrame) -> DataFrame:
    return _with_shares(_airport_level(routes, "carrier", "carrier_name"), "carrier", "pct_of_carrier_system")


def carrier_month_of(routes: DataFrame) -> DataFrame:
    return _system_level(_airport_level(routes, "carrier", "carrier_name"), "carrier", "carrier_name")


def _family_named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"key": "family", "key_name": "family_name"})


def airport_family_month_at(family_routes: DataFrame) -> DataFrame:
    airports = _family_named(_airport_level(family_routes, "key", "key_name"))
    return _with_shares(airports, "family", "pct_of_family_system")


def family_month_at(family_routes: DataFrame) -> DataFrame:
    airports = _family_named(_airport_level(family_routes, "key", "key_name"))
    return _system_level(airports, "family", "family_name")


def route_carrier_month(fact: DataFrame) -> DataFrame:
    """Month x carrier x directed route with both endpoints' geography."""
    return route_carrier_month_of(route_level(fact))


def airport_carrier_month(fact: DataFrame) -> DataFrame:
    """Month x airport x carrier with the airport's weight for the carrier and the carrier's at the airport."""
    return airport_carrier_month_of(route_level(fact))


def carrier_month(fact: DataFrame) -> DataFrame:
    """Month x carrier system totals."""
    return carrier_month_of(route_level(fact))


def airport_family_month(fact: DataFrame, families: DataFrame) -> DataFrame:
    return airport_family_month_at(family_route_level(route_level(fact), families))


def family_month(fact: DataFrame, families: DataFrame) -> DataFrame:
    return family_month_at(family_route_level(route_level(fact), families))
