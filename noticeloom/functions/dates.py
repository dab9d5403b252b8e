"""Dates and times read from text. Impossible dates become null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.functions.text import _col, trim_ws


def compact_date(c, end_of_day: bool = False) -> Column:
    """``yyyyMMdd`` → timestamp at the start or the last second of that day."""
    text = trim_ws(c)
    start = F.when(F.length(text) == 8, F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    if end_of_day:
        return start + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(59), F.lit(59))
    return start


def year_of(c) -> Column:
    """Two-digit years belong to this century."""
    year = _col(c).try_cast("int")
    return F.when(year < 100, year + 2000).otherwise(year)


def parts_to_timestamp(year, month, day, hour, minute, end_of_day: bool = False) -> Column:
    """Text parts → timestamp; a missing time means the day's start or its last second."""
    number = lambda c: F.nullif(_col(c), F.lit("")).try_cast("int")
    hour, minute = number(hour), number(minute)
    no_time = hour.isNull() & minute.isNull()
    last = F.lit(end_of_day) & no_time
    return F.try_make_timestamp(
        year_of(year), number(month), number(day),
        F.when(last, 23).otherwise(F.coalesce(hour, F.lit(0))),
        F.when(last, 59).otherwise(F.coalesce(minute, F.lit(0))),
        F.when(last, 59).otherwise(F.lit(0)).cast("decimal(16,6)"))


def same_day(a, b) -> Column:
    """True, false, or null when either day is unknown."""
    return F.to_date(_col(a)) == F.to_date(_col(b))


def older_than(posted, cutoff) -> Column:
    """Both known and posted before the cutoff; unknown dates are never old."""
    return F.coalesce(_col(posted) < cutoff, F.lit(False))


def iso_timestamp(c) -> Column:
    return F.coalesce(F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit(""))


def iso_date(c) -> Column:
    return F.coalesce(F.date_format(_col(c), "yyyy-MM-dd"), F.lit(""))
