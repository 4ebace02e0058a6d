"""Small hand-made frames in the shape of the gold route table."""

from __future__ import annotations

import datetime as dt

ROUTE_SCHEMA = (
    "flight_month date, carrier string, carrier_name string, origin string, origin_city string, origin_country string, "
    "origin_lat double, origin_lon double, dest string, dest_city string, dest_country string, dest_lat double, "
    "dest_lon double, distance_miles double, departures bigint, seats bigint, passengers bigint"
)


def month(n: int) -> dt.date:
    """The n-th month from January 2000 on."""
    return dt.date(2000 + n // 12, n % 12 + 1, 1)


def route(n, carrier, origin, dest, seats, passengers=None, **over):
    row = {
        "flight_month": month(n), "carrier": carrier, "carrier_name": f"{carrier} Air",
        "origin": origin, "origin_city": f"{origin} City, X", "origin_country": "Elsewhere", "origin_lat": 1.0, "origin_lon": 2.0,
        "dest": dest, "dest_city": f"{dest} City, X", "dest_country": "Elsewhere", "dest_lat": 3.0, "dest_lon": 4.0,
        "distance_miles": 100.0, "departures": 1, "seats": seats, "passengers": seats // 2 if passengers is None else passengers,
    }
    return {**row, **over}


def routes(spark, rows):
    names = [f.strip().split(" ")[0] for f in ROUTE_SCHEMA.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ROUTE_SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
