"""Maps the star-schema test tables onto the warehouse's shapes.

A line item becomes one row of a carrier's (brand's) monthly service from the supplier's place
to the customer's. ``fine`` uses nations as airports, ``coarse`` uses regions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.operators.family import family_frame
from skyledger.operators.joins import broadcast_if_files_small

REF_YEAR = 2000

# Which brands form a family; brands not listed stay on their own.
STAND_IN_FAMILIES = [
    ("Brand#1", "Brand#1", "One Group", None, "survivor"),
    ("Brand#6", "Brand#1", "One Group", "1997-06-01", "joined One"),
    ("Brand#11", "Brand#1", "One Group", "1997-06-01", "joined One"),
    ("Brand#2", "Brand#2", "Two Group", None, "survivor"),
    ("Brand#7", "Brand#2", "Two Group", "1998-03-01", "joined Two"),
    ("Brand#12", "Brand#2", "Two Group", "1996-01-01", "joined Two"),
    ("Brand#3", "Brand#3", "Three Group", None, "survivor"),
    ("Brand#8", "Brand#3", "Three Group", "1999-10-01", "joined Three"),
    ("Brand#4", "Brand#4", "Four Group", None, "survivor"),
    ("Brand#9", "Brand#4", "Four Group", "2000-05-01", "joined Four"),
    ("Brand#14", "Brand#4", "Four Group", "2001-02-01", "joined Four"),
    ("Brand#19", "Brand#4", "Four Group", None, "brand kept"),
    ("Brand#5", "Brand#5", "Five Group", None, "survivor"),
    ("Brand#10", "Brand#5", "Five Group", "1995-12-01", "joined Five"),
    ("Brand#99", "Brand#98", "Idle Group", None, "never flew"),
]


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read once per process, later scans are given the schema."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def families(spark: SparkSession) -> DataFrame:
    return family_frame(spark, STAND_IN_FAMILIES)


def places(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """Code, city, country and position of every nation (fine) or region (coarse).

    One place of each grain has no country and no position, one nation has no city either.
    """
    region = table(spark, sf_dir, "region")
    country = F.when(F.col("r_name") == "AMERICA", "United States").otherwise(F.col("r_name"))
    if grain == "coarse":
        key = F.col("r_regionkey")
        known = key != 4
        return region.select(
            key.alias("place"),
            F.concat(F.lit("RG"), key).alias("code"),
            F.concat("r_name", F.lit(", WORLD")).alias("city"),
            F.when(known, country).alias("country"),
            F.when(known, key * F.lit(3.5) - 40).alias("lat"),
            F.when(known, key * F.lit(10) - 120.5).alias("lon"),
        )
    key = F.col("n_nationkey")
    known = key != 24
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("place"),
            _code(key).alias("code"),
            F.when(known, F.concat("n_name", F.lit(", "), "r_name")).alias("city"),
            F.when(known, country).alias("country"),
            F.when(known, key * F.lit(3.5) - 40).alias("lat"),
            F.when(known, key * F.lit(10) - 120.5).alias("lon"),
        )
    )


def _code(nation: Column | str) -> Column:
    """``N`` and the nation's number in two digits; a formatter would be made anew for every row."""
    nation = F.col(nation) if isinstance(nation, str) else nation
    return F.concat(F.when(nation < 10, "N0").otherwise("N"), nation)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with brand, type and the two nation and region keys: only numbers travel through the big joins."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    orders, supplier = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    buyers = (
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", F.col("c_nationkey").alias("dest_nation"), F.col("n_regionkey").alias("dest_region"))
    )
    sellers = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("s_nationkey").alias("origin_nation"), F.col("n_regionkey").alias("origin_region"))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (
        table(spark, sf_dir, "lineitem")
        .join(broadcast_if_files_small(buyers, orders), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(broadcast_if_files_small(sellers, supplier), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumns(
            {
                "flight_month": F.trunc("l_shipdate", "month"),
                "data_scope": F.when(F.col("origin_region") == F.col("dest_region"), "domestic").otherwise("international"),
                "quantity": F.col("l_quantity").cast("bigint"),
                "percent_off": F.round(F.col("l_discount") * 100).cast("bigint"),
            }
        )
    )


def _carrier_name() -> Column:
    """Brands were renamed at the start of 1998."""
    suffix = F.when(F.col("flight_month") < F.lit("1998-01-01").cast("date"), " Air").otherwise(" Airlines")
    return F.concat("p_brand", suffix)


def segment(spark: SparkSession, sf_dir: str, grain: str = "fine") -> DataFrame:
    """Silver-shaped segment rows, typed (any finer grain aggregates to the same gold)."""
    unit = "nation" if grain == "fine" else "region"
    rows = _lines(spark, sf_dir).withColumns(
        {
            "seats": F.col("quantity") * 100,
            "passengers": F.col("quantity") * (100 - 5 * F.col("percent_off")),
            "distance_miles": (F.abs(F.col(f"origin_{unit}") - F.col(f"dest_{unit}")) * 100 + 50).cast("double"),
        }
    )
    where = places(spark, sf_dir, grain)
    for side in ("origin", "dest"):
        here = where.select(*[F.col(c).alias(f"{side}_{c}") for c in where.columns])
        rows = rows.join(here, F.col(f"{side}_{unit}") == F.col(f"{side}_place"))
    moved = (F.col("flight_month") >= F.lit("2001-01-01").cast("date")) & (F.lit(grain) == "fine")
    home = F.when(F.col("data_scope") == "domestic", F.concat(F.lit("S"), F.col("origin_region")))
    return rows.select(
        "flight_month", "data_scope",
        F.col("p_brand").alias("carrier"), _carrier_name().alias("carrier_name"),
        F.col("origin_code").alias("origin"),
        F.when(moved & (F.col("origin_place") == 7), "NEW TOWN, ASIA").otherwise(F.col("origin_city")).alias("origin_city"),
        home.alias("origin_state"), "origin_country", "origin_lat", "origin_lon",
        F.col("dest_code").alias("dest"),
        F.when(moved & (F.col("dest_place") == 7), "NEW TOWN, ASIA").otherwise(F.col("dest_city")).alias("dest_city"),
        home.alias("dest_state"), "dest_country", "dest_lat", "dest_lon",
        F.col("p_type").alias("aircraft_type"),
        F.when(F.col("l_returnflag") == "R", "L").otherwise("F").alias("service_class"),
        (F.col("l_linenumber") + 1).cast("bigint").alias("departures_scheduled"),
        F.col("l_linenumber").cast("bigint").alias("departures_performed"),
        "seats", "passengers", "distance_miles",
    )


def bronze_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as raw text, with blanks, junk and odd spellings in cells chosen by line number and tax."""
    line, tax = F.col("l_linenumber"), F.round(F.col("l_tax") * 100).cast("int")
    seats = (F.col("quantity") * 100).cast("string")
    pax = (F.col("quantity") * (100 - 5 * F.col("percent_off"))).cast("string")
    domestic = F.col("data_scope") == "domestic"

    def country(side: str) -> Column:
        return F.when(~domestic, F.concat(F.lit("Country "), F.col(f"{side}_region"))).otherwise("")

    def state(side: str) -> Column:
        return F.when(domestic, F.concat(F.lit("S"), F.col(f"{side}_region")))

    return _lines(spark, sf_dir).select(
        (line + 1).cast("string").alias("departures_scheduled"),
        line.cast("string").alias("departures_performed"),
        (F.col("quantity") * 200).cast("string").alias("payload"),
        F.when((tax == 0) & (line == 1), "")
        .when((tax == 0) & (line == 2), "1,234")
        .when((tax == 0) & (line == 3), F.concat(seats, F.lit(".")))
        .when((tax == 0) & (line == 4), F.concat(seats, F.lit(".00")))
        .otherwise(seats)
        .alias("seats"),
        F.when((tax == 0) & (line == 5), "1e3").when((tax == 0) & (line == 6), F.concat(F.lit(" "), pax)).otherwise(pax).alias("passengers"),
        F.concat(line.cast("string"), F.lit(".5")).alias("freight"),
        F.concat(F.lit("-"), line.cast("string")).alias("mail"),
        (F.abs(F.col("origin_nation") - F.col("dest_nation")) * 100 + 50).cast("string").alias("distance"),
        (line * 60).cast("string").alias("ramp_to_ramp"),
        (line * 45).cast("string").alias("air_time"),
        F.col("p_brand").alias("unique_carrier"),
        _carrier_name().alias("unique_carrier_name"),
        F.col("p_brand").alias("carrier"),
        _code("origin_nation").alias("origin"),
        F.concat(F.lit("City "), "origin_nation", F.lit(', "quoted"')).alias("origin_city_name"),
        state("origin").alias("origin_state_abr"),
        country("origin").alias("origin_country_name"),
        _code("dest_nation").alias("dest"),
        F.concat(F.lit("City "), "dest_nation", F.lit(', "quoted"')).alias("dest_city_name"),
        state("dest").alias("dest_state_abr"),
        country("dest").alias("dest_country_name"),
        F.col("p_type").alias("aircraft_type"),
        F.when((tax == 8) & (line == 7), "19x0").otherwise(F.year("flight_month").cast("string")).alias("year"),
        F.when((tax == 8) & (line == 6), "13").otherwise(F.month("flight_month").cast("string")).alias("month"),
        F.when(F.col("l_returnflag") == "R", "L").otherwise("F").alias("class"),
        F.col("data_scope").alias("_data_scope"),
    )


def bronze_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless-file shape of the nations: one absent, one twice, invalid codes among them."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")

    def rows(source: DataFrame, airport_id: Column, name: Column, iata: Column) -> DataFrame:
        return source.select(
            airport_id.cast("string").alias("airport_id"),
            name.alias("name"),
            F.col("n_name").alias("city"),
            F.when(F.col("r_name") == "AMERICA", "United States").otherwise(F.col("r_name")).alias("country"),
            iata.alias("iata"),
            F.when(key % 2 == 0, "\\N").otherwise(F.format_string("IC%02d", key)).alias("icao"),
            (key * F.lit(3.5) - 40).cast("string").alias("latitude"),
            (key * F.lit(10) - 120.5).cast("string").alias("longitude"),
            F.when(key == 5, "n/a").otherwise((key * 11 - 20).cast("string")).alias("altitude_ft"),
            F.lit("0").alias("utc_offset"),
            F.lit("U").alias("dst"),
            F.when(key % 3 == 0, "\\N").otherwise(F.concat(F.lit("Zone/"), key)).alias("tz_database"),
            F.lit("airport").alias("type"),
            F.lit("nations").alias("source"),
        )

    code = _code(key)
    port = F.concat("n_name", F.lit(" Field"))
    return (
        rows(nation.filter(key != 24), key + 100, port, code)
        .unionByName(rows(nation.filter(key == 3), key + 9, F.lit("Elder Field"), code))
        .unionByName(rows(nation.filter(key == 4), key + 1000, F.lit("Younger Field"), code))
        .unionByName(rows(nation.filter(key < 3), key + 2000, port, F.lit("\\N")))
        .unionByName(rows(nation.filter(key < 3), key + 3000, port, F.lower(code)))
    )


def lookup_aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft types from the parts, each code twice under two descriptions."""
    types = table(spark, sf_dir, "part").select(F.col("p_type").alias("code")).distinct()
    return types.select("code", F.explode(F.array(F.lower("code"), F.concat(F.lit("the "), F.lower("code")))).alias("description"))


def lookup_class(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(pa.table({"code": ["F", "G"], "description": ["Scheduled passenger", "Scheduled cargo"]}))
