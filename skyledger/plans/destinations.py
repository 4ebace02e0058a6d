"""Destination reports: every airport's nonstops, best and worst routes, momentum.

``routes`` is the gold route x carrier table: unique per month, carrier, origin and dest, so
inside one carrier-route a count of rows is a count of months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.semantics import is_domestic, month_between, per_month, ratio, round_even
from skyledger.operators.periods import pivot_periods, with_latest, with_period
from skyledger.operators.ranking import head_tail, lump_other, top_k

ROUTE_KEY = ["origin", "carrier", "carrier_name", "dest", "dest_city"]


def select_routes(routes: DataFrame, start=None, end=None, carriers: list[str] | None = None) -> DataFrame:
    """The page's selection: a month window and, when given, chosen carriers."""
    rows = routes.filter(month_between("flight_month", start, end))
    return rows if carriers is None else rows.filter(F.col("carrier").isin(carriers))


def _ranked(rows: DataFrame, per: list[str], *ties: str) -> DataFrame:
    # Without a key all rows are ranked together: they are airports, of which there are few.
    order = Window.partitionBy(*(per or [F.lit(0)])).orderBy(F.desc_nulls_last("seats"), *ties)
    return rows.withColumn("rank", F.row_number().over(order))


def airport_picker(routes: DataFrame, given_origin: bool = False) -> DataFrame:
    """Origins with their city by rank of their total seats, or with ``given_origin`` the dests of every origin."""
    keys, city = (["origin", "dest"], "dest_city") if given_origin else (["origin"], "origin_city")
    picked = routes.groupBy(*keys).agg(F.max(city).alias("city"), F.sum("seats").alias("seats"))
    return _ranked(picked, ["origin"], "dest") if given_origin else _ranked(picked, [], "origin")


def carrier_picker(routes: DataFrame, per: tuple[str, ...] = ("origin",)) -> DataFrame:
    """Carriers of every origin (or of every route, with ``per`` origin and dest) by rank of their seats."""
    picked = routes.groupBy(*per, "carrier").agg(F.max("carrier_name").alias("carrier_name"), F.sum("seats").alias("seats"))
    return _ranked(picked, list(per), "carrier")


def destinations(selected: DataFrame) -> DataFrame:
    """Per origin and dest: city, position, seats, passengers, carriers, load factor."""
    by_carrier = selected.filter(F.col("dest").isNotNull()).groupBy("origin", "dest", "carrier").agg(
        F.max("dest_city").alias("dest_city"),
        F.max("dest_lat").alias("d_lat"),
        F.max("dest_lon").alias("d_lon"),
        F.sum("seats").alias("seats"),
        F.sum("passengers").alias("passengers"),
    )
    return (
        by_carrier.groupBy("origin", "dest")
        .agg(
            F.max("dest_city").alias("dest_city"),
            F.max("d_lat").alias("d_lat"),
            F.max("d_lon").alias("d_lon"),
            F.sum("seats").alias("seats"),
            F.sum("passengers").alias("passengers"),
            F.count("carrier").alias("carriers"),
        )
        .withColumn("load_factor", ratio("passengers", "seats"))
    )


def destinations_headline(selected: DataFrame) -> DataFrame:
    """Per origin: destinations, those without a position, carriers, passengers, load factor."""
    by_carrier = selected.groupBy("origin", "dest", "carrier").agg(
        F.max("dest_lat").alias("d_lat"),
        F.max("dest_lon").alias("d_lon"),
        F.sum("seats").alias("seats"),
        F.sum("passengers").alias("passengers"),
    )
    located = F.col("d_lat").isNotNull() & F.col("d_lon").isNotNull()
    return (
        by_carrier.groupBy("origin")
        .agg(
            F.count_distinct("dest").alias("destinations"),
            F.count_distinct(F.when(located, F.col("dest"))).alias("_located"),
            F.count_distinct("carrier").alias("carriers"),
            F.sum("seats").alias("seats"),
            F.sum("passengers").alias("passengers"),
        )
        .withColumn("unmapped", F.col("destinations") - F.col("_located"))
        .withColumn("load_factor", ratio("passengers", "seats"))
        .drop("_located")
    )


def top_destinations(selected: DataFrame, n: int = 15) -> DataFrame:
    totals = selected.filter(F.col("dest").isNotNull()).groupBy("origin", "dest").agg(F.sum("seats").alias("seats"))
    return top_k(totals, ["origin"], "seats", ["dest"], n)


def top_destinations_by_carrier(
    window: DataFrame, n_dest: int = 15, n_carrier: int = 10, carriers: list[str] | None = None
) -> DataFrame:
    """Seats of each origin's top dests split by its top carriers' names, the rest as "Other".

    ``window`` has all carriers of the months looked at: the named ones are the largest among all of them, also
    when only the picked ``carriers`` are shown.
    """
    every = window.groupBy("origin", "dest", "carrier", "carrier_name").agg(F.sum("seats").alias("seats"))
    base = every if carriers is None else every.filter(F.col("carrier").isin(carriers))
    top = top_destinations(base, n_dest).select("origin", "dest")
    per_carrier = (
        every.filter(F.col("carrier_name").isNotNull())
        .groupBy("origin", "carrier", "carrier_name")
        .agg(F.sum("seats").alias("seats"))
    )
    names = top_k(per_carrier, ["origin"], "seats", ["carrier", "carrier_name"], n_carrier)
    lumped = lump_other(base.join(top, ["origin", "dest"], "left_semi"), names, ["origin"], "carrier_name")
    return lumped.groupBy("origin", "dest", "carrier_name").agg(F.sum("seats").alias("seats"))


def destination_trend(selected: DataFrame) -> DataFrame:
    """Destinations served per origin and month, with seats, passengers, load factor."""
    by_dest = selected.groupBy("origin", "flight_month", "dest").agg(
        F.sum("seats").alias("seats"), F.sum("passengers").alias("passengers")
    )
    return (
        by_dest.groupBy("origin", "flight_month")
        .agg(F.count("dest").alias("destinations"), F.sum("seats").alias("seats"), F.sum("passengers").alias("passengers"))
        .withColumn("load_factor", ratio("passengers", "seats"))
    )


def _scoped(rows: DataFrame, scope: str) -> DataFrame:
    """Drop self-loops, mark domestic dests, keep the asked-for scope."""
    rows = rows.filter(F.col("dest") != F.col("origin")).withColumn("domestic", is_domestic("dest_country"))
    return rows if scope == "All" else rows.filter(F.col("domestic") == (scope == "Domestic"))


def qualifying_routes(selected: DataFrame, scope: str = "All", floor: float = 500) -> DataFrame:
    """Carrier-routes with sustained service, their load factor and the origin's average over them.

    At least three months served, ``floor`` seats a month and any seats at all. Routes without a
    known city or country stay in.
    """
    perf = (
        _scoped(selected, scope)
        .groupBy("origin", "carrier", "carrier_name", "dest", "dest_city", "dest_country", "domestic")
        .agg(
            F.sum("seats").alias("seats"),
            F.sum("passengers").alias("passengers"),
            F.count(F.lit(1)).alias("months"),
        )
        .withColumn("seats_mo", per_month("seats", "months"))
        .filter((F.col("months") >= 3) & (F.col("seats_mo") >= floor) & (F.col("seats") > 0))
    )
    airport = Window.partitionBy("origin")
    return perf.withColumns(
        {
            "load_factor": ratio("passengers", "seats"),
            "empty_seats": F.col("seats") - F.col("passengers"),
            "scope_load_factor": ratio(F.sum("passengers").over(airport), F.sum("seats").over(airport)),
        }
    )


def route_performers(selected: DataFrame, scope: str = "All", floor: float = 500, n_each: int = 5) -> DataFrame:
    """The best and worst load factors of every origin."""
    ranked = qualifying_routes(selected, scope, floor)
    return head_tail(ranked, ["origin"], "load_factor", ["carrier", "carrier_name", "dest", "dest_city"], n_each, "worst", "best")


def yoy_momentum(
    routes: DataFrame, scope: str = "All", floor: float = 500, n_each: int = 5, as_of=None
) -> DataFrame:
    """Load-factor change over calendar months served in both years; the most declining and improving."""
    years = with_period(_scoped(with_latest(routes, ["origin"], as_of), scope)).withColumn("moy", F.month("flight_month"))
    by_month = pivot_periods(years, [*ROUTE_KEY, "moy"], ["seats", "passengers"])
    matched = by_month.filter((F.col("seats_latest") > 0) & (F.col("seats_prior") > 0))
    deltas = (
        matched.groupBy(*ROUTE_KEY)
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.sum("seats_latest").alias("seats_latest"),
            F.sum("passengers_latest").alias("pax_latest"),
            F.sum("seats_prior").alias("seats_prior"),
            F.sum("passengers_prior").alias("pax_prior"),
        )
        .withColumn("seats_mo", per_month("seats_latest", "months"))
        .filter((F.col("months") >= 3) & (F.col("seats_mo") >= floor))
        .withColumns({"lf_latest": ratio("pax_latest", "seats_latest"), "lf_prior": ratio("pax_prior", "seats_prior")})
        .withColumn("delta_pp", F.col("lf_latest") - F.col("lf_prior"))
    )
    return head_tail(deltas, ["origin"], "delta_pp", ["carrier", "carrier_name", "dest", "dest_city"], n_each, "declining", "improving")


def changed_routes(routes: DataFrame, scope: str = "All", floor: float = 500, as_of=None) -> DataFrame:
    """Every carrier-route flown in just one of the two years, at least two months and ``floor`` seats a month."""
    years = with_period(_scoped(with_latest(routes, ["origin"], as_of), scope))
    wide = pivot_periods(years, ROUTE_KEY, ["seats", "passengers"], months=True)

    def only_in(period: str, other: str) -> Column:
        enough = per_month(f"seats_{period}", f"months_{period}") >= floor
        return (F.col(f"months_{period}") >= 2) & (F.col(f"months_{other}") == 0) & enough

    change = F.when(only_in("latest", "prior"), "new").when(only_in("prior", "latest"), "dropped")
    flown = F.when(F.col("change") == "new", F.lit("latest")).otherwise(F.lit("prior"))

    def of(measure: str) -> Column:
        return F.when(flown == "latest", F.col(f"{measure}_latest")).otherwise(F.col(f"{measure}_prior"))

    return (
        wide.withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(
            *ROUTE_KEY,
            "change",
            round_even(per_month(of("seats"), of("months"))).alias("seats_mo"),
            of("months").alias("months"),
            round_even(ratio(of("passengers"), of("seats")), 1).alias("lf_pct"),
        )
    )


def new_dropped_routes(routes: DataFrame, scope: str = "All", floor: float = 500, n: int = 12, as_of=None) -> DataFrame:
    """The largest new and dropped routes of every origin, with how many there are in all."""
    changed = changed_routes(routes, scope, floor, as_of).withColumn(
        "n_routes", F.count(F.lit(1)).over(Window.partitionBy("origin", "change"))
    )
    return top_k(changed, ["origin", "change"], "seats_mo", ["carrier", "dest", "carrier_name", "dest_city"], n)
