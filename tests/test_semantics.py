import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyledger.functions import semantics as s


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "text, number",
    [("12", 12), ("12.", 12), ("-3", -3), ("0.25", Decimal("0.25")), ("", None), ("1e3", None), (" 12", None),
     ("1,234", None), ("12\n", None), (".5", None), ("--1", None), ("NULL", None), (None, None)],
)
def test_to_num_takes_plain_decimals_only(spark, text, number):
    assert one(spark, s.to_num("x"), text) == number


@pytest.mark.parametrize("number, whole", [("2.5", 3), ("-2.5", -3), ("2.49", 2), ("0.5", 1), (None, None)])
def test_to_bigint_rounds_halves_away_from_zero(spark, number, whole):
    assert one(spark, s.to_bigint("x"), number and Decimal(number), "decimal(28,6)") == whole


@pytest.mark.parametrize(
    "part, whole, digits, result",
    [(1, 3, 1, 33.3), (2, 3, 1, 66.7), (1, 8, 1, 12.5), (1, 800, 1, 0.1), (5, 4000, 2, 0.13), (-1, 800, 1, -0.1),
     (1, 0, 1, None), (None, 5, 1, None), (5, None, 2, None), (9_000_000_000_000_000_000, 9_000_000_000_000_000_000, 2, 100.0)],
)
def test_pct_is_exact(spark, part, whole, digits, result):
    df = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
    assert df.select(s.pct("p", "w", digits).alias("y")).first().y == result


@pytest.mark.parametrize(
    "year, month, first",
    [("2001", "2", dt.date(2001, 2, 1)), ("2001", "12", dt.date(2001, 12, 1)), ("2001", "13", None), ("2001", "00", None),
     ("19x0", "1", None), ("0000", "1", None), (None, "1", None)],
)
def test_month_start(spark, year, month, first):
    df = spark.createDataFrame([(year, month)], "y string, m string")
    assert df.select(s.month_start("y", "m").alias("d")).first().d == first


def test_valid_period_and_iata(spark):
    df = spark.createDataFrame([("2001", "1"), ("2001", "1\n"), ("19x0", "1"), ("2001", "123"), ("02001", "1")], "y string, m string")
    assert [r.v for r in df.select(s.valid_period("y", "m").alias("v")).collect()] == [True, False, False, False, False]
    codes = spark.createDataFrame([("ABC",), ("A1C",), ("abc",), ("\\N",), ("ABCD",), ("ABC\n",)], "x string")
    assert [r.v for r in codes.select(s.valid_iata("x").alias("v")).collect()] == [True, True, False, False, False, False]


@pytest.mark.parametrize("number, digits, result", [(0.5, 0, 0.0), (1.5, 0, 2.0), (2.5, 0, 2.0), (0.25, 1, 0.2), (0.35, 1, 0.4), (66.666, 1, 66.7)])
def test_round_even(spark, number, digits, result):
    assert one(spark, s.round_even("x", digits), number, "double") == result


def test_trailing_window_is_half_open(spark):
    df = spark.createDataFrame([(dt.date(2000, m, 1),) for m in range(1, 13)] + [(dt.date(2001, 1, 1),)], "d date")
    kept = df.filter(s.trailing_months("d", F.lit("2001-01-01").cast("date"), 12))
    assert kept.count() == 12 and kept.agg(F.min("d")).first()[0] == dt.date(2000, 2, 1)


def test_domestic_includes_unknown_country(spark):
    df = spark.createDataFrame([(None,), ("United States",), ("Peru",)], "c string")
    assert [r.v for r in df.select(s.is_domestic("c").alias("v")).collect()] == [True, True, False]


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(s.ratio(F.lit(5), F.lit(0)).alias("y")).first().y is None
