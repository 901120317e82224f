"""Scalar column functions. All built-in expressions."""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(year: str | Column, month: str | Column) -> Column:
    """first day of (year, month); invalid parts -> NULL (``errors='coerce'``).

    Built from zero-padded text with ``try_to_date`` because ``make_date``
    raises under ANSI mode.
    """
    y = F.lpad(_c(year).cast("string"), 4, "0")
    m = F.lpad(_c(month).cast("string"), 2, "0")
    return F.try_to_date(F.concat(y, F.lit("-"), m, F.lit("-01")), "yyyy-MM-dd")


def months_back(d: str | Column, n: int) -> Column:
    """subtract ``n`` months."""
    return F.add_months(_c(d), -n)


def month_sequence(start: str | Column, count: int, skip_first: bool = True) -> Column:
    """array of ``count`` month starts after ``start`` (pandas
    ``date_range(freq='MS')[1:]``)."""
    first = 1 if skip_first else 0
    return F.sequence(F.add_months(_c(start), first), F.add_months(_c(start), first + count - 1),
                      F.expr("INTERVAL 1 MONTH"))


def year_month_text(d: str | Column) -> Column:
    """``%Y-%m``."""
    return F.date_format(_c(d), "yyyy-MM")


def hour_of(heure: str | Column) -> Column:
    """hour from ``HH:MM:SS`` text or an integer hour; default 0."""
    s = F.trim(_c(heure).cast("string"))
    first = F.split(s, ":").getItem(0)
    digits = F.regexp_extract(first, r"(\d+)", 1)
    return F.coalesce((F.nullif(digits, F.lit(""))).try_cast("int"), F.lit(0))


def rush_hour(hour: str | Column) -> Column:
    """1 when the hour is in 7-9 or 17-19 (inclusive)."""
    h = _c(hour)
    return (h.between(7, 9) | h.between(17, 19)).cast("int")


def flag01(c: str | Column) -> Column:
    """0/1 flag from text or numbers; anything unparsable -> 0."""
    return F.coalesce((_c(c).cast("string")).try_cast("int"), F.lit(0))


def month_sin(month: str | Column, period: int = 12) -> Column:
    """F8: cyclical month encoding."""
    return F.sin(F.lit(2 * math.pi) * _c(month) / F.lit(float(period)))


def month_cos(month: str | Column, period: int = 12) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(month) / F.lit(float(period)))


def round_half_even(c: str | Column, scale: int) -> Column:
    """pandas/numpy rounding (half to even): ``bround``, not ``round``."""
    return F.bround(_c(c), scale)


def zscore(c: str | Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std with missing (incl. std 0) -> 0."""
    return F.coalesce(F.try_divide(_c(c) - mean, std), F.lit(0.0))


# -- F13: French public holidays -----------------------------------------------
# The metropolitan-France public holidays. Fixed-date ones as
# (month, day); movable ones as day offsets from Easter Sunday.
FR_FIXED_HOLIDAYS = [
    (1, 1, "Jour de l'an"),
    (5, 1, "Fete du Travail"),
    (5, 8, "Victoire 1945"),
    (7, 14, "Fete nationale"),
    (8, 15, "Assomption"),
    (11, 1, "Toussaint"),
    (11, 11, "Armistice 1918"),
    (12, 25, "Noel"),
]
FR_EASTER_OFFSETS = [
    (1, "Lundi de Paques"),
    (39, "Ascension"),
    (50, "Lundi de Pentecote"),
]


def easter_sunday(year: int) -> _dt.date:
    """Gregorian Easter (anonymous Gregorian algorithm)."""
    a = year % 19
    b, c = divmod(year, 100)
    d, e = divmod(b, 4)
    f = (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * l_) // 451
    month, day = divmod(h + l_ - 7 * m + 114, 31)
    return _dt.date(year, month, day + 1)


def fr_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Holiday dimension (ds date, holiday string); a few rows per year, so it
    is bounded by the calendar and broadcast wherever it is joined."""
    rows = []
    for y in range(first_year, last_year + 1):
        for m, d, name in FR_FIXED_HOLIDAYS:
            rows.append((_dt.date(y, m, d), name))
        e = easter_sunday(y)
        for off, name in FR_EASTER_OFFSETS:
            rows.append((e + _dt.timedelta(days=off), name))
    schema = T.StructType([T.StructField("ds", T.DateType()), T.StructField("holiday", T.StringType())])
    return spark.createDataFrame(rows, schema)
