"""Registered queries: each reads the given tables whole and returns one frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.checks import landing
from skyledger.functions import semantics as s
from skyledger.operators.rolling import roll12, roll_months
from skyledger.plans import churn, destinations, families, gold, hubs, routes, silver
from skyledger.session import work_dir
from skyledger.sources import driver_tables as d
from skyledger.sources.driver_tables import REF_YEAR

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of fractions depend on the order of summation in the last bit."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _rcm(spark: SparkSession, sf: str, grain: str = "fine") -> DataFrame:
    return gold.route_carrier_month(d.segment(spark, sf, grain))


def _acm(spark: SparkSession, sf: str) -> DataFrame:
    return gold.airport_carrier_month(d.segment(spark, sf))


def _cm(spark: SparkSession, sf: str) -> DataFrame:
    return gold.carrier_month(d.segment(spark, sf))


def _fm(spark: SparkSession, sf: str) -> DataFrame:
    return gold.family_month(d.segment(spark, sf), d.families(spark))


def _afm(spark: SparkSession, sf: str) -> DataFrame:
    return gold.airport_family_month(d.segment(spark, sf), d.families(spark))


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return routes.route_monthly(_rcm(spark, sf), d.families(spark))


def _stored(df: DataFrame) -> DataFrame:
    """A gold frame as reports meet it: written once to the shared work folder, read as often as they need."""
    path = work_dir(df.sparkSession, "gold")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _typed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return (
        d.bronze_segment(spark, sf)
        .groupBy(
            F.col("_data_scope").alias("data_scope"), "year", "month", s.valid_period("year", "month").alias("valid_period")
        )
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(s.to_num("seats")).alias("seats_numbers"),
            F.sum(s.to_num("seats")).cast("double").alias("seats_sum"),
            F.count(s.to_num("passengers")).alias("passengers_numbers"),
            F.sum(s.to_num("freight")).cast("double").alias("freight_sum"),
            F.sum(s.to_num("mail")).cast("double").alias("mail_sum"),
            F.count(s.blank_to_null("origin_country_name")).alias("countries"),
        )
    )


def _latest_month(spark: SparkSession, sf: str) -> DataFrame:
    rcm = _rcm(spark, sf)
    return (
        rcm.filter(F.col("flight_month") == s.latest_month(rcm))
        .groupBy("carrier", "flight_month")
        .agg(F.sum("seats").alias("seats"))
    )


def _flown(spark: SparkSession, sf: str) -> DataFrame:
    """The merger map cut to carriers that occur in the tables."""
    return d.families(spark).join(d.segment(spark, sf).select("carrier").distinct(), "carrier", "left_semi")


QUERIES: dict[str, Query] = {
    # landing
    "read_text_csv": landing.read_text_csv,
    "decode_fallback": landing.decode_fallback,
    "ragged_rows": landing.ragged_rows,
    "backfill": landing.backfill,
    "expand_archives": landing.expand_archives,
    "load_replace_years": landing.load_replace_years,
    "load_replace_scope": landing.load_replace_scope,
    "load_append": landing.load_append,
    "load_lookup": landing.load_lookup,
    "batch_log": landing.batch_log,
    "period_range": landing.period_range,
    "refresh_all": landing.refresh_all,
    "refresh_market": landing.refresh_market,
    "refresh_changed": landing.refresh_changed,
    "rejected_rows": landing.rejected_rows,
    "export_sorted": landing.export_sorted,
    # silver
    "typed_bronze": _typed_bronze,
    "rejected_periods": lambda spark, sf: silver.rejected_periods(d.bronze_segment(spark, sf)),
    "dim_airport": lambda spark, sf: silver.dim_airport(d.bronze_airports(spark, sf)),
    "duplicate_codes": lambda spark, sf: silver.duplicate_codes(d.lookup_aircraft(spark, sf)),
    "fact_segment": lambda spark, sf: silver.fact_segment(
        d.bronze_segment(spark, sf),
        silver.dim_airport(d.bronze_airports(spark, sf)),
        d.lookup_aircraft(spark, sf),
        d.lookup_class(spark),
    ),
    "fact_market": lambda spark, sf: silver.fact_market(
        d.bronze_segment(spark, sf), silver.dim_airport(d.bronze_airports(spark, sf)), d.lookup_class(spark)
    ),
    # gold
    "route_carrier_month": _rcm,
    "airport_carrier_month": _acm,
    "carrier_month": _cm,
    "family_month": _fm,
    "airport_family_month": _afm,
    "latest_month": _latest_month,
    "served_months": lambda spark, sf: hubs.served_months(_cm(spark, sf)),
    "served_months_by_airport": lambda spark, sf: hubs.served_months(_acm(spark, sf), ["carrier", "airport"]),
    "roll12": lambda spark, sf: _rounded(
        roll12(_cm(spark, sf), ["carrier"], "seats", "load_factor_pct").select(
            "flight_month", "carrier", "seats", "seats_12m", "load_factor_pct_12m"
        ),
        "load_factor_pct_12m",
    ),
    "roll_months": lambda spark, sf: roll_months(_acm(spark, sf), ["carrier", "airport"], "seats", least=6).select(
        "flight_month", "carrier", "airport", "seats", "seats_12mo"
    ),
    # routes
    "route_monthly": _monthly,
    "route_monthly_carriers": lambda spark, sf: routes.route_monthly(_rcm(spark, sf), both=False),
    "route_either_direction": lambda spark, sf: _rcm(spark, sf)
    .filter(s.either_direction("N03", "N11"))
    .select("flight_month", "carrier", "origin", "dest", "seats", "passengers"),
    "route_headline": lambda spark, sf: routes.route_headline(_stored(_monthly(spark, sf))),
    "route_load_factor": lambda spark, sf: _rounded(routes.route_load_factor(_monthly(spark, sf), True), "load_factor_12m"),
    "route_capacity_demand": lambda spark, sf: routes.route_capacity_demand(_monthly(spark, sf), True),
    "share_gap": lambda spark, sf: routes.share_gap(_monthly(spark, sf)),
    # hubs
    "top_carriers": lambda spark, sf: hubs.top_carriers(_cm(spark, sf), REF_YEAR, 8),
    "top_families": lambda spark, sf: hubs.top_carriers(_fm(spark, sf), REF_YEAR, 12, "family", "family_name"),
    "majors_trend": lambda spark, sf: hubs.majors_trend(_stored(_cm(spark, sf)), REF_YEAR, 8),
    "top_hubs": lambda spark, sf: hubs.top_hubs(_acm(spark, sf), REF_YEAR, 6),
    "hub_trend": lambda spark, sf: _rounded(
        hubs.hub_trend(
            _stored(_afm(spark, sf)), REF_YEAR, 6, "family", "pct_of_family_system", start="1997-01-01", end="2000-12-01"
        ),
        "system_share_12m",
        "airport_share_12m",
    ),
    "hub_trend_carriers": lambda spark, sf: hubs.hub_trend(_stored(_acm(spark, sf)), REF_YEAR, 3, smooth=False),
    "spokes": lambda spark, sf: hubs.spokes(_stored(_rcm(spark, sf)), d.families(spark)),
    "spokes_of_month": lambda spark, sf: hubs.spokes(_rcm(spark, sf), month=f"{REF_YEAR}-07-01"),
    "fortress_pairs": lambda spark, sf: _rounded(
        hubs.fortress_pairs(
            _acm(spark, sf), [("N01", "Brand#1"), ("N03", "Brand#12"), ("N07", "Brand#4"), ("N24", "Brand#25")]
        ),
        "pct_12m",
    ),
    "dehub": lambda spark, sf: hubs.dehub(_acm(spark, sf), ["N02", "N05", "N07", "N11", "N24"]),
    # destinations
    "airport_picker": lambda spark, sf: destinations.airport_picker(_rcm(spark, sf)),
    "dest_picker": lambda spark, sf: destinations.airport_picker(_rcm(spark, sf), given_origin=True),
    "carrier_picker": lambda spark, sf: destinations.carrier_picker(_rcm(spark, sf)),
    "route_carrier_picker": lambda spark, sf: destinations.carrier_picker(_rcm(spark, sf), ("origin", "dest")),
    "destinations": lambda spark, sf: destinations.destinations(_rcm(spark, sf)),
    "destinations_headline": lambda spark, sf: destinations.destinations_headline(
        destinations.select_routes(_rcm(spark, sf), "1998-01-01", "2001-06-01")
    ),
    "top_destinations": lambda spark, sf: destinations.top_destinations(_rcm(spark, sf)),
    "top_destinations_by_carrier": lambda spark, sf: destinations.top_destinations_by_carrier(_stored(_rcm(spark, sf))),
    "top_destinations_picked_carriers": lambda spark, sf: destinations.top_destinations_by_carrier(
        _stored(_rcm(spark, sf)), carriers=["Brand#11", "Brand#12", "Brand#13", "Brand#25", "Brand#31"]
    ),
    "destination_trend": lambda spark, sf: destinations.destination_trend(_rcm(spark, sf)),
    "qualifying_routes": lambda spark, sf: destinations.qualifying_routes(_rcm(spark, sf, "coarse"), "International"),
    "route_performers": lambda spark, sf: destinations.route_performers(_rcm(spark, sf, "coarse")),
    "route_performers_domestic": lambda spark, sf: destinations.route_performers(
        _rcm(spark, sf, "coarse"), "Domestic", 4500, 10
    ),
    "yoy_momentum": lambda spark, sf: destinations.yoy_momentum(_stored(_rcm(spark, sf, "coarse"))),
    "changed_routes": lambda spark, sf: destinations.changed_routes(_stored(_rcm(spark, sf)), floor=0),
    "new_dropped_routes": lambda spark, sf: destinations.new_dropped_routes(_stored(_rcm(spark, sf))),
    # families
    "family_summary": lambda spark, sf: families.family_summary(d.families(spark), _stored(_fm(spark, sf))),
    "merger_timeline": lambda spark, sf: families.merger_timeline(_flown(spark, sf)),
    "merger_markers": lambda spark, sf: families.merger_markers(_flown(spark, sf), "1996-01-01", "2000-12-01"),
    "merger_members_flown": lambda spark, sf: families.members_flown(d.families(spark), _cm(spark, sf)),
    "family_members_trend": lambda spark, sf: families.family_members_trend(_cm(spark, sf), d.families(spark)),
    "family_network_trend": lambda spark, sf: families.family_network_trend(_fm(spark, sf)),
    "family_headline": lambda spark, sf: families.family_headline(_stored(_fm(spark, sf)), _stored(_cm(spark, sf)), d.families(spark)),
    # churn
    "service_gaps": lambda spark, sf: churn.service_gaps(_rcm(spark, sf), d.families(spark)),
    "route_churn": lambda spark, sf: churn.route_churn(_stored(_rcm(spark, sf)), d.families(spark)),
    "churn_long": lambda spark, sf: churn.churn_long(
        churn.route_churn(_stored(_rcm(spark, sf)), d.families(spark), floor=0), 1997, 2000
    ),
    "pair_periods": lambda spark, sf: churn.pair_periods(_stored(_rcm(spark, sf)), d.families(spark)),
    "recent_moves": lambda spark, sf: churn.recent_moves(_stored(_rcm(spark, sf)), d.families(spark)),
}
