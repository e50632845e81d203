"""Calendar and clock helpers for zone-less timestamps.

Each is written so that the session time zone never enters: parts are taken from
the wall clock, and differences are interval arithmetic.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime | str | Column) -> Column:
    """A zone-less timestamp from a literal or a column."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    return F.lit(str(moment)).cast("timestamp_ntz")


def date_key(ts: Column) -> Column:
    """Calendar key such as 20240315."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def year_month(ts: Column) -> Column:
    """Cohort label such as ``2024-03``."""
    return F.date_format(ts.cast("date"), "yyyy-MM")


def month_name(ts: Column) -> Column:
    return F.date_format(ts.cast("date"), "MMMM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts.cast("date"), "EEEE")


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def day_of_week(ts: Column) -> Column:
    """0 for Sunday up to 6 for Saturday (Spark counts from 1)."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return day_of_week(ts).isin(0, 6)


def quarter_hour_key(ts: Column) -> Column:
    """Clock key HHMM rounded down to a quarter hour: 14:37 gives 1430."""
    return (F.hour(ts) * 100 + F.floor(F.minute(ts) / 15) * 15).cast("int")


def minute_number(ts: Column) -> Column:
    """Minutes since 1970-01-01 on the wall clock."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes as a decimal of fifteen places, sub-seconds included."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return seconds.cast("decimal(24,12)") / F.lit(60).cast("decimal(2,0)")


def months_before(moment: Column, months: int) -> Column:
    """The same wall-clock time some months earlier, clamped to the month's end."""
    return moment - F.make_ym_interval(F.lit(0), F.lit(months))


def days(number: int) -> Column:
    return F.make_dt_interval(F.lit(number))
