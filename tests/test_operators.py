import pytest
from frames import month, rows
from pyspark.sql import functions as F

from skyledger.operators.family import FAMILY_ROWS, family_frame, with_key
from skyledger.operators.grouping import sum_with_labels
from skyledger.operators.joins import broadcast_if_small
from skyledger.operators.periods import pivot_periods, with_latest, with_period
from skyledger.operators.ranking import head_tail, lump_other, top_k
from skyledger.operators.rolling import roll12, smooth_then_window


def series(spark, values, key="k", skip=()):
    data = [(key, month(i), float(v) if v is not None else None) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(data, "key string, flight_month date, v double")


def test_roll12_needs_twelve_rows(spark):
    out = [r.v_12m for r in roll12(series(spark, range(14)), ["key"], "v").orderBy("flight_month").collect()]
    assert out == [None] * 11 + [5.5, 6.5, 7.5]


def test_roll12_counts_rows_over_a_gap_and_needs_values(spark):
    gap = roll12(series(spark, range(14), skip=(3,)), ["key"], "v").orderBy("flight_month").collect()
    assert [r.v_12m for r in gap][-2:] == [(sum(range(13)) - 3) / 12, (sum(range(1, 14)) - 3) / 12]
    hole = roll12(series(spark, [None, *range(1, 14)]), ["key"], "v").orderBy("flight_month").collect()
    assert [r.v_12m for r in hole] == [None] * 12 + [6.5, 7.5]


def test_smoothing_comes_before_the_window(spark):
    out = smooth_then_window(series(spark, range(14)), ["key"], ["v"], start=month(12)).orderBy("flight_month").collect()
    assert [r.v_12m for r in out] == [6.5, 7.5]


def ranked(spark, n):
    return spark.createDataFrame([("g", f"t{i:02d}", float(i)) for i in range(n)], "g string, t string, v double")


@pytest.mark.parametrize(
    "n, worst, best",
    [(1, 0, 0), (2, 1, 1), (3, 1, 2), (7, 3, 4), (10, 5, 5), (11, 5, 5), (30, 5, 5)],
)
def test_head_tail_split(spark, n, worst, best):
    out = head_tail(ranked(spark, n), ["g"], "v", ["t"], 5, "worst", "best").collect()
    lows, highs = [r.v for r in out if r.side == "worst"], [r.v for r in out if r.side == "best"]
    assert (len(lows), len(highs)) == (worst, best)
    assert sorted(lows) == [float(i) for i in range(worst)]
    assert sorted(highs) == [float(i) for i in range(n - best, n)]


def test_top_k_breaks_ties_by_key_and_puts_nulls_last(spark):
    df = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "c", None), ("g", "d", 1)], "g string, t string, v int")
    assert rows(top_k(df, ["g"], "v", ["t"], 3), "rank", "t") == [(1, "a"), (2, "b"), (3, "d")]


def test_lump_other_keeps_named_and_lumps_null(spark):
    df = spark.createDataFrame([("o", "A"), ("o", "B"), ("o", None), ("p", "A")], "origin string, name string")
    named = spark.createDataFrame([("o", "A")], "origin string, name string")
    assert rows(lump_other(df, named, ["origin"], "name"), "origin", "name") == [("o", "A"), ("o", "Other"), ("o", "Other"), ("p", "Other")]


def test_periods_label_24_months_from_each_keys_last(spark):
    data = [("a", month(i)) for i in range(30)] + [("b", month(i)) for i in range(10)]
    df = with_period(with_latest(spark.createDataFrame(data, "k string, flight_month date"), ["k"]))
    assert rows(df.groupBy("k", "period").count(), "k", "period", "count") == [("a", "latest", 12), ("a", "prior", 12), ("b", "latest", 10)]


def test_pivot_drops_null_keys_and_fills_zero(spark):
    df = spark.createDataFrame([("x", "latest", 5), (None, "latest", 9)], "k string, period string, seats int")
    assert rows(pivot_periods(df, ["k"], ["seats"], months=True), "k", "seats_latest", "seats_prior", "months_latest", "months_prior") == [("x", 5, 0, 1, 0)]


def test_family_seed_and_key(spark):
    fam = family_frame(spark)
    assert fam.count() == len(FAMILY_ROWS) == 14 and fam.select("family").distinct().count() == 5
    df = spark.createDataFrame([("NW", "Northwest"), ("ZZ", "Zed")], "carrier string, carrier_name string")
    assert rows(with_key(df, fam), "carrier", "key", "key_name") == [("NW", "DL", "Delta Air Lines family"), ("ZZ", "ZZ", "Zed")]
    assert rows(with_key(df, None), "key") == [("NW",), ("ZZ",)]
    with pytest.raises(ValueError):
        family_frame(spark, [FAMILY_ROWS[0], FAMILY_ROWS[0]])


def test_sum_with_labels_equals_a_plain_aggregate(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("k"), F.concat(F.lit("n"), F.col("id") % 5).alias("name"), F.col("id").alias("v"),
        (F.col("id") % 11 == 3).alias("f"),
    )
    plain = df.groupBy("k").agg(F.max("name").alias("name"), F.sum("v").alias("v"), F.bool_or("f").alias("f"))
    assert rows(sum_with_labels(df, ["k"], ["name"], ["v"], flags=["f"]), "k", "name", "v", "f") == rows(plain, "k", "name", "v", "f")


def test_broadcast_only_below_the_bound(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(spark.range(10), 10)) and not hinted(broadcast_if_small(spark.range(11), 10))


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    rows_ = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50_000).alias("k"), F.lit("n").alias("name"), F.lit(1).alias("v")
    )
    out = sum_with_labels(rows_, ["k"], ["name"], ["v"])
    assert rows(out.filter("k = -1"), "v") == [(100_000,)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "partial_sum" in plan and "partial_max" in plan
