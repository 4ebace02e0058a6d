"""Value semantics shared by every layer: casts, rounding, ratios, months, null order.

Everything here is a column expression, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The cell formats that the raw files use. \z, not $: Java's $ also matches before a final newline.
NUMERIC = r"^-?[0-9]+\.?[0-9]*\z"
IATA = r"^[A-Z0-9]{3}\z"
YEAR = r"^[0-9]{4}\z"
MONTH = r"^[0-9]{1,2}\z"
DIGITS = r"^[0-9]+\z"

MEASURE = T.DecimalType(28, 6)
COORDINATE = T.DecimalType(38, 18)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_num(c: Column | str, to: T.DecimalType = MEASURE) -> Column:
    """Text to an exact number; anything but a plain signed decimal becomes NULL."""
    c = _col(c)
    return F.when(c.rlike(NUMERIC), c.try_cast(to))


def is_number(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(NUMERIC), F.lit(False))


def fits(c: Column | str, to: T.DecimalType = MEASURE) -> Column:
    """Whether the exact type holds a number's text: its integer part, and no digit of its fraction lost."""
    c = _col(c)
    fraction = F.regexp_replace(F.regexp_extract(c, r"\.([0-9]*)\z", 1), "0+\\z", "")
    return c.try_cast(to).isNotNull() & (F.length(fraction) <= to.scale)


def to_bigint(c: Column | str) -> Column:
    """Exact number to long, halves away from zero (a bare cast would truncate)."""
    return F.round(_col(c), 0).cast("bigint")


def null_sentinel(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit("\\N"))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def valid_iata(c: Column | str) -> Column:
    c = _col(c)
    return (c != F.lit("\\N")) & c.rlike(IATA)


def valid_period(year: Column | str, month: Column | str) -> Column:
    return _col(year).rlike(YEAR) & _col(month).rlike(MONTH)


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month as DATE; NULL when there is no such month (00, 13, ...)."""
    y, m = _col(year).try_cast("int"), _col(month).try_cast("int")
    return F.when((y >= 1) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def pct(part: Column | str, whole: Column | str, digits: int) -> Column:
    """``round(100 * part / whole, digits)`` on whole numbers, halves away from zero.

    The quotient is taken in integer steps, so no binary fraction is ever rounded. Decimal
    intermediates leave room for any pair of longs. NULL when ``whole`` is zero.
    """
    part, whole = _col(part), _col(whole)
    unit = 10**digits
    p = F.abs(part).cast("decimal(20,0)")
    w = F.nullif(F.abs(whole).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    steps = F.call_function("div", p * F.lit(200 * unit) + w, w * F.lit(2))
    signed = F.when((part < 0) != (whole < 0), -steps).otherwise(steps)
    return signed.cast("double") / F.lit(float(unit))


def load_factor_pct(passengers: Column | str, seats: Column | str) -> Column:
    """Load factor of gold rows: a ratio of sums, one digit."""
    return pct(passengers, seats, 1)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole`` as double, NULL instead of a division by zero."""
    whole = _col(whole).cast("double")
    return F.lit(100.0) * _col(part).cast("double") / F.nullif(whole, F.lit(0.0))


def per_month(total: Column | str, months: Column | str) -> Column:
    months = _col(months).cast("double")
    return _col(total).cast("double") / F.nullif(months, F.lit(0.0))


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round a double as numpy does: scale, nearest even, scale back."""
    unit = float(10**digits)
    return F.rint(_col(c) * F.lit(unit)) / F.lit(unit)


def clip_low(c: Column | str, low: int = 1) -> Column:
    return F.greatest(_col(c), F.lit(low))


def month_between(c: Column | str, start=None, end=None) -> Column:
    """Inclusive month range; an open end is no restriction."""
    c = _col(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (c <= F.lit(end).cast("date"))
    return cond


def trailing_months(c: Column | str, end: Column, n: int) -> Column:
    """The half-open window of ``n`` months that ends with ``end``."""
    c = _col(c)
    return (c > F.add_months(end, -n)) & (c <= end)


def year_bounds(year: int) -> tuple[str, str]:
    return f"{year:04d}-01-01", f"{year:04d}-12-01"


def latest_month(df: DataFrame, column: str = "flight_month") -> Column:
    """The table's last month as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def city_before_comma(c: Column | str) -> Column:
    return F.substring_index(F.coalesce(_col(c), F.lit("?")), ",", 1)


def is_domestic(country: Column | str) -> Column:
    """An unknown country is a small home airport missing from the geography."""
    country = _col(country)
    return country.isNull() | (country == "United States")


def either_direction(origin: str, dest: str, both: bool = True) -> Column:
    """Rows of one picked route, with the return leg when ``both``."""
    there = (F.col("origin") == origin) & (F.col("dest") == dest)
    back = (F.col("origin") == dest) & (F.col("dest") == origin)
    return there | back if both else there
