"""Merger families: the authored map and the code/family switch."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAMILY_SCHEMA = pa.schema(
    [
        ("carrier", pa.string()),
        ("family", pa.string()),
        ("family_name", pa.string()),
        ("merged_month", pa.date32()),
        ("note", pa.string()),
    ]
)

# Carrier code, surviving family, family name, month merged (None for the survivor), note.
FAMILY_ROWS = [
    ("AA", "AA", "American Airlines family", None, "survivor"),
    ("TW", "AA", "American Airlines family", "2001-12-01", "TWA, acquired by American 2001"),
    ("US", "AA", "American Airlines family", "2015-10-01", "US Airways, merged into American (last US flight Oct 2015)"),
    ("HP", "AA", "American Airlines family", "2007-09-01", "America West, merged into US Airways (single certificate 2007), then American"),
    ("DL", "DL", "Delta Air Lines family", None, "survivor"),
    ("NW", "DL", "Delta Air Lines family", "2010-01-01", "Northwest, merged into Delta (single certificate Dec 2009)"),
    ("UA", "UA", "United Airlines family", None, "survivor"),
    ("CO", "UA", "United Airlines family", "2012-03-01", "Continental, merged into United (single certificate Nov 2011)"),
    ("CS", "UA", "United Airlines family", "2012-03-01", 'Continental Micronesia ("Air Mike"), folded into United'),
    ("WN", "WN", "Southwest Airlines family", None, "survivor"),
    ("FL", "WN", "Southwest Airlines family", "2014-12-01", "AirTran, acquired by Southwest (last FL flight Dec 2014)"),
    ("AS", "AS", "Alaska Air Group family", None, "survivor"),
    ("VX", "AS", "Alaska Air Group family", "2018-04-01", "Virgin America, merged into Alaska (single certificate Jan 2018)"),
    ("HA", "AS", "Alaska Air Group family", "2025-10-01", "Hawaiian, acquired by Alaska Air Group Sep 2024; brand retained"),
]


def family_frame(spark: SparkSession, rows=FAMILY_ROWS) -> DataFrame:
    """The merger map as a local relation: its exact size is known to the optimizer.

    Refuses a map in which a carrier appears twice, since it would multiply every sum.
    """
    codes = [r[0] for r in rows]
    if len(set(codes)) != len(codes):
        raise ValueError("a carrier may belong to one family only")
    fixed = [{**dict(zip(FAMILY_SCHEMA.names, r)), "merged_month": r[3] and dt.date.fromisoformat(r[3])} for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(fixed, schema=FAMILY_SCHEMA))


def with_key(df: DataFrame, families: DataFrame | None) -> DataFrame:
    """Add ``key`` and ``key_name``: the carrier itself, or its family when a map is given.

    An unmapped carrier is its own family. The merged month takes no part in the join.
    """
    if families is None:
        return df.withColumns({"key": F.col("carrier"), "key_name": F.col("carrier_name")})
    names = families.select("carrier", F.col("family").alias("_family"), F.col("family_name").alias("_family_name"))
    return (
        df.join(names, "carrier", "left")
        .withColumns(
            {
                "key": F.coalesce("_family", "carrier"),
                "key_name": F.coalesce("_family_name", "carrier_name"),
            }
        )
        .drop("_family", "_family_name")
    )
