import datetime as dt

import pytest
from frames import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyledger.plans import gold, silver
from skyledger.sources import driver_tables as d
from skyledger.sources.schemas import AIRPORT_COLUMNS, MARKET_COLUMNS, SEGMENT_COLUMNS

SF = "/root/testdata/sf0.001"


def bronze(spark, *cells, columns=SEGMENT_COLUMNS):
    base = {
        "unique_carrier": "AA", "unique_carrier_name": "American", "carrier": "XX", "origin": "AAA", "dest": "BBB",
        "aircraft_type": "6", "class": "F", "year": "2001", "month": "2", "seats": "100", "passengers": "50",
        "_data_scope": "domestic",
    }
    names = [*columns, "_data_scope"]
    return spark.createDataFrame([tuple({**base, **c}.get(n) for n in names) for c in cells], ", ".join(f"{n} string" for n in names))


def airports(spark, *cells):
    base = {"airport_id": "1", "name": "Field", "city": "Town", "country": "Peru", "icao": "\\N", "latitude": "-6.081689834590001",
            "longitude": "10", "altitude_ft": "10.5", "tz_database": "\\N"}
    data = [tuple({**base, **c}.get(n) for n in AIRPORT_COLUMNS) for c in cells]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in AIRPORT_COLUMNS))


def lookup(spark, *pairs):
    return spark.createDataFrame(list(pairs), "code string, description string")


def fact(spark, rows_, air=None, types=(("6", "Jet"),), classes=(("F", "Scheduled"),), **kw):
    air = silver.dim_airport(air if air is not None else airports(spark, {"iata": "AAA"}))
    return silver.fact_segment(rows_, air, lookup(spark, *types), lookup(spark, *classes), **kw)


def test_dim_airport_one_row_per_valid_code(spark):
    raw = airports(
        spark, {"iata": "AAA", "airport_id": "10", "name": "late"}, {"iata": "AAA", "airport_id": "9", "name": "early"},
        {"iata": "AAA", "airport_id": "x", "name": "none"}, {"iata": "\\N"}, {"iata": "ab1"}, {"iata": "B2C", "icao": "KBBB"},
    )
    out = silver.dim_airport(raw)
    assert rows(out, "iata", "airport_name", "icao", "latitude", "altitude_ft", "tz_database") == [
        ("AAA", "early", None, -6.081689834590001, 11, None), ("B2C", "Field", "KBBB", -6.081689834590001, 11, None),
    ]


def test_rows_of_one_grain_are_summed_and_rounded(spark):
    df = fact(spark, bronze(spark, {"freight": "1.25", "region": "A"}, {"freight": "1.25", "region": "B", "unique_carrier_name": "Zeta"}))
    assert rows(df, "carrier", "carrier_name", "seats", "freight_lb", "mail_lb", "flight_month") == [("AA", "Zeta", 200, 3, None, dt.date(2001, 2, 1))]


def test_duplicate_decode_codes_do_not_double_sums(spark):
    df = fact(spark, bronze(spark, {}), types=(("6", "Jet"), ("6", "Old jet")))
    assert rows(df, "seats", "aircraft_type_name", "service_class_name") == [(100, "Old jet", "Scheduled")]
    assert rows(silver.duplicate_codes(lookup(spark, ("6", "a"), ("6", "b"), ("7", "c"))), "code", "copies") == [("6", 2)]


@pytest.mark.parametrize(
    "cells, country",
    [(({},), "Peru"), (({"origin_country_name": "Chile"},), "Chile"), (({"origin_country_name": ""},), "Peru"),
     (({"origin_country_name": "Chile"}, {}), "Peru"), (({"origin_country_name": "Zaire"}, {}), "Zaire")],
)
def test_country_falls_back_to_geography(spark, cells, country):
    assert rows(fact(spark, bronze(spark, *cells)), "origin_country", "dest_country") == [(country, None)]


def test_unknown_airport_keeps_the_row(spark):
    assert rows(fact(spark, bronze(spark, {"origin": "QQQ"})), "origin", "origin_lat", "seats") == [("QQQ", None, 100)]


def test_bad_months_are_set_aside_or_raise(spark):
    raw = bronze(spark, {"month": "13"}, {"month": "00"}, {"month": "13"}, {"year": "19x0"}, {})
    assert rows(fact(spark, raw), "seats") == [(100,)]
    assert rows(silver.rejected_periods(raw), "month", "rows") == [("00", 1), ("13", 2)]
    with pytest.raises(PySparkException, match="no such month"):
        fact(spark, raw, strict=True).collect()


def test_market_has_no_capacity(spark):
    raw = bronze(spark, {"passengers": "7"}, {"passengers": "8", "class": "G"}, columns=MARKET_COLUMNS)
    air = silver.dim_airport(airports(spark, {"iata": "AAA"}))
    out = silver.fact_market(raw, air, lookup(spark, ("F", "Scheduled")))
    assert rows(out, "service_class", "passengers") == [("F", 7), ("G", 8)]
    assert not {"seats", "aircraft_type"} & set(out.columns)


def test_silver_grain_is_unique(spark):
    out = silver.fact_segment(
        d.bronze_segment(spark, SF), silver.dim_airport(d.bronze_airports(spark, SF)), d.lookup_aircraft(spark, SF), d.lookup_class(spark)
    )
    keys = ["flight_month", "data_scope", "carrier", "origin", "dest", "aircraft_type", "service_class"]
    assert out.count() == out.select(*keys).distinct().count()


def test_gold_counts_scheduled_service_only_and_matches_direct_counts(spark):
    seg = d.segment(spark, SF).cache()
    cm = gold.carrier_month(seg)
    direct = (
        seg.filter("service_class = 'F'")
        .groupBy("flight_month", "carrier")
        .agg(F.count_distinct("origin").alias("a"), F.count_distinct(F.concat("origin", F.lit(">"), "dest")).alias("r"), F.sum("seats").alias("s"))
    )
    assert rows(cm, "flight_month", "carrier", "airports_served", "routes_served", "seats") == rows(direct, "flight_month", "carrier", "a", "r", "s")
    seg.unpersist()


def test_shares_sum_to_hundred_and_families_to_their_members(spark):
    seg, fam = d.segment(spark, SF), d.families(spark)
    acm = gold.airport_carrier_month(seg)
    for key, share in (("carrier", "pct_of_carrier_system"), ("airport", "pct_of_airport_seats")):
        off = acm.groupBy("flight_month", key).agg(F.sum(share).alias("s"), F.count("*").alias("n")).filter("abs(s - 100) > 0.005 * n + 1e-6")
        assert off.count() == 0
    cm = gold.carrier_month(seg).join(fam, "carrier", "left").withColumn("family", F.coalesce("family", "carrier"))
    members = cm.groupBy("flight_month", "family").agg(F.sum("seats").alias("seats"))
    assert rows(gold.family_month(seg, fam), "flight_month", "family", "seats") == rows(members, "flight_month", "family", "seats")


def test_load_factor_without_seats_is_null(spark):
    schema = "flight_month date, carrier string, carrier_name string, origin string, dest string, service_class string, departures_performed bigint, seats bigint, passengers bigint"
    df = spark.createDataFrame([(dt.date(2000, 1, 1), "A", "A", "X", "Y", "F", 1, 0, 5)], schema)
    for c in gold.ROUTE_LABELS:
        df = df.withColumn(c, F.lit(None).cast("string"))
    for c in gold.ROUTE_NUMBERS:
        df = df.withColumn(c, F.lit(None).cast("double"))
    assert rows(gold.carrier_month(df), "load_factor_pct", "routes_served") == [(None, 1)]
    assert rows(gold.airport_carrier_month(df), "pct_of_carrier_system") == [(None,)]


def test_facts_are_not_interpreted_in_sessions_of_others(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert rows(fact(other, bronze(other, {})), "seats") == [(100,)]
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_short_and_long_numbers_that_are_not_held(spark):
    cells = ["1.123456", "1.1234567", "12345678", "1" * 22, "1" * 23, "-1.10000000", "1,23456789", None]
    found = silver.unheld_numbers(bronze(spark, *[{"freight": c} for c in cells]), ["freight", "mail"])
    assert rows(found, "field", "value", "rows") == [("freight", "1.1234567", 1), ("freight", "1" * 23, 1)]
