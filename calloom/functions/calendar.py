"""Calendar expressions. All take and return Columns; none reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAY_SECONDS = 86_400

Date = dt.date | str


def as_date(value: Date | Column) -> Column:
    """A date parameter (``date``, ISO text or Column) as a DATE Column."""
    return value.cast("date") if isinstance(value, Column) else F.lit(str(value)).cast("date")


def half_month(date: Column) -> Column:
    """First day of the half month as text: ``YYYY-MM-01`` up to the 14th, else ``YYYY-MM-15``."""
    half = F.when(F.dayofmonth(date) < 15, "01").otherwise("15")
    return F.concat(F.date_format(date, "yyyy-MM"), F.lit("-"), half)


def month_key(date: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(date, "yyyy-MM")


def year_key(date: Column) -> Column:
    """``YYYY``."""
    return F.date_format(date, "yyyy")


def iso_week_number(date: Column) -> Column:
    """ISO week ``01``-``53`` as text."""
    return F.lpad(F.weekofyear(date).cast("string"), 2, "0")


def iso_week(date: Column) -> Column:
    """ISO reporting week ``YYYY-Www``, with the ISO year."""
    year = F.extract(F.lit("YEAROFWEEK"), date).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lit("-W"), iso_week_number(date))


def monday_week(date: Column) -> Column:
    """Calendar year and Monday-based week ``YYYY-Www``; days before the first Monday are week 00."""
    week = F.floor((F.dayofyear(date) + 6 - F.weekday(date)) / 7)
    return F.concat(F.date_format(date, "yyyy"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def iso_weekday(date: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(date) + 1


def day_name(date: Column) -> Column:
    """English weekday name."""
    return F.date_format(date, "EEEE")


def seconds_of_day(ts: Column) -> Column:
    """Time of day as whole seconds since midnight (Spark's TIME type is not generally usable)."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def hour_start(ts: Column) -> Column:
    """The full hour before a timestamp; unlike ``date_trunc`` it keeps zoneless timestamps zoneless."""
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, F.minute(ts), F.extract(F.lit("SECOND"), ts))


def hour_number(ts: Column) -> Column:
    """Hours since 1970 by the clock reading of the timestamp."""
    return F.datediff(ts, F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def time_text(seconds: Column) -> Column:
    """Seconds of day as ``HH:mm:ss``."""
    hours, minutes, rest = [
        F.lpad(part.cast("string"), 2, "0")
        for part in (F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)
    ]
    return F.concat(hours, F.lit(":"), minutes, F.lit(":"), rest)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Second boundaries between two timestamps, whatever the session time zone."""
    days = F.datediff(later, earlier).cast("long")
    return days * DAY_SECONDS + (seconds_of_day(later) - seconds_of_day(earlier))


def days_between(later: Column, earlier: Column) -> Column:
    """Day boundaries between two dates or timestamps."""
    return F.datediff(later, earlier)


def age_days(cohort: Column, lead: Column) -> Column:
    """Days from lead to cohort date; a lead later than the cohort date has no age."""
    return F.when(lead <= cohort, F.datediff(cohort, lead))


def days(start: Column, end: Column) -> Column:
    """The dates from start to end as an array, null where end lies before start."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))


def within(date: Column, as_of: Date, oldest: int, newest: int = 0) -> Column:
    """Whether a date lies between ``oldest`` and ``newest`` days before ``as_of``, both included."""
    return date.between(F.date_sub(as_date(as_of), oldest), F.date_sub(as_date(as_of), newest))
