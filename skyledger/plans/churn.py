"""Network churn: undirected city pairs a family adds and ends.

With ``families`` None every carrier is its own family.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.semantics import (
    city_before_comma,
    clip_low,
    month_between,
    per_month,
    ratio,
    round_even,
)
from skyledger.operators.family import with_key
from skyledger.operators.periods import with_latest, with_period
from skyledger.operators.ranking import top_k

PAIR = ["family", "a", "b"]


def _pairs(routes: DataFrame, families: DataFrame | None) -> DataFrame:
    """Undirected pairs without self-loops, keyed by family."""
    return _undirected(with_key(routes, families).withColumnRenamed("key", "family"))


def _undirected(keyed: DataFrame) -> DataFrame:
    ends = {"a": F.least("origin", "dest"), "b": F.greatest("origin", "dest")}
    return keyed.filter(F.col("origin") != F.col("dest")).withColumns(ends)


def service_gaps(routes: DataFrame, families: DataFrame | None, floor: float = 500) -> DataFrame:
    """Months in which a pair reached ``floor`` seats, with the served months before and after."""
    served = (
        _pairs(routes, families)
        .groupBy(*PAIR, "flight_month")
        .agg(F.sum("seats").alias("seats"))
        .filter(F.col("seats") >= floor)
    )
    w = Window.partitionBy(*PAIR).orderBy("flight_month")
    return served.withColumns(
        {"prev_month": F.lag("flight_month").over(w), "next_month": F.lead("flight_month").over(w)}
    )


def route_churn(
    routes: DataFrame, families: DataFrame | None, floor: float = 500, horizon=None, since=None
) -> DataFrame:
    """City pairs added and ended per family and year.

    A pair is added after more than 366 days without service and ended before as many. Exits
    after ``horizon`` cannot be confirmed yet (default: twelve months before the family's last
    month), and the first year of data, before ``since``, has no past to compare with.
    """
    month = F.col("flight_month")
    if since is None:
        first = routes.agg(F.min("flight_month")).scalar()
        since = F.add_months(F.trunc(first, "year"), 12)
    else:
        since = F.lit(since).cast("date")
    gaps = service_gaps(routes, families, floor)
    if horizon is None:
        ends = (
            with_key(routes, families)
            .groupBy(F.col("key").alias("family"))
            .agg(F.add_months(F.max("flight_month"), -12).alias("_horizon"))
        )
        gaps = gaps.join(ends, "family")
    else:
        gaps = gaps.withColumn("_horizon", F.lit(horizon).cast("date"))
    added = F.col("prev_month").isNull() | (F.datediff(month, "prev_month") > 366)
    silent = F.col("next_month").isNull() | (F.datediff("next_month", month) > 366)
    return (
        gaps.filter(month >= since)
        .groupBy("family", F.year("flight_month").alias("year"))
        .agg(F.count_if(added).alias("added"), F.count_if(silent & (month <= F.col("_horizon"))).alias("ended"))
    )


def churn_long(churn: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Added counts up, ended counts down: one row per family, year and kind."""
    if start_year is not None:
        churn = churn.filter(F.col("year") >= start_year)
    if end_year is not None:
        churn = churn.filter(F.col("year") <= end_year)
    return churn.withColumn("ended", -F.col("ended")).unpivot(["family", "year"], ["added", "ended"], "what", "n")


def pair_periods(routes: DataFrame, families: DataFrame | None, as_of=None) -> DataFrame:
    """Per family and pair: cities, months, seats, passengers and operators of the last two years.

    The family's last month is that of all its rows, self-loops included. Months are kept as bits (at most twelve per period), so two directions and several operators
    of a pair can be merged in any order without a distinct count.
    """
    keyed = with_latest(with_key(routes, families).withColumnRenamed("key", "family"), ["family"], as_of)
    years = with_period(_undirected(keyed))
    forward = F.col("origin") < F.col("dest")
    rows = years.withColumns(
        {
            "a_city": F.when(forward, F.col("origin_city")).otherwise(F.col("dest_city")),
            "b_city": F.when(forward, F.col("dest_city")).otherwise(F.col("origin_city")),
            "month_bit": F.call_function("shiftleft", F.lit(1), F.month("flight_month") - 1),
        }
    )
    per_operator = rows.groupBy(*PAIR, "period", "carrier").agg(
        F.max("a_city").alias("a_city"),
        F.max("b_city").alias("b_city"),
        F.bit_or("month_bit").alias("month_bits"),
        F.sum("seats").alias("seats"),
        F.sum("passengers").alias("passengers"),
    )
    return per_operator.groupBy(*PAIR, "period").agg(
        F.max("a_city").alias("a_city"),
        F.max("b_city").alias("b_city"),
        F.bit_count(F.bit_or("month_bits")).cast("bigint").alias("months"),
        F.sum("seats").alias("seats"),
        F.sum("passengers").alias("passengers"),
        F.expr("listagg(carrier, ', ') WITHIN GROUP (ORDER BY carrier)").alias("operators"),
    )


def changed_pairs(routes: DataFrame, families: DataFrame | None, floor: float = 500, as_of=None) -> DataFrame:
    """Every pair flown in just one of the two years, at least two months and ``floor`` seats a month.

    City names belong to the key: a pair whose city was renamed between the years counts as ended
    and added. Pairs without a city name are left out.
    """
    named = pair_periods(routes, families, as_of).na.drop(subset=["a_city", "b_city"])
    key = [*PAIR, "a_city", "b_city"]
    lonely = named.groupBy(*key).agg(
        F.count_if(F.col("months") > 0).alias("periods"),
        *[F.max(c).alias(c) for c in ("period", "months", "seats", "passengers", "operators")],
    )
    enough = per_month("seats", clip_low("months")) >= floor
    return lonely.filter((F.col("periods") == 1) & (F.col("months") >= 2) & enough).select(
        *key,
        F.when(F.col("period") == "latest", "added").otherwise("ended").alias("move"),
        F.concat(city_before_comma("a_city"), F.lit(" - "), city_before_comma("b_city")).alias("cities"),
        F.coalesce("operators", F.lit("")).alias("operators"),
        round_even(per_month("seats", "months")).alias("seats_mo"),
        "months",
        round_even(ratio("passengers", "seats"), 1).alias("lf_pct"),
    )


def recent_moves(
    routes: DataFrame, families: DataFrame | None, floor: float = 500, n: int = 15, as_of=None
) -> DataFrame:
    """The largest added and ended pairs of every family, with how many there are in all."""
    moves = changed_pairs(routes, families, floor, as_of).withColumn(
        "n_pairs", F.count(F.lit(1)).over(Window.partitionBy("family", "move"))
    )
    return top_k(moves, ["family", "move"], "seats_mo", ["a", "b", "a_city", "b_city"], n)
