"""Date columns. Times are wall-clock times without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.functions.text import as_column

# --- fixed values: accepted ISO shapes ---------------------------------------------
_DAY = r"\d{4}-?\d{2}-?\d{2}"
_WEEK = r"\d{4}(?:-W\d{2}(?:-\d)?|W\d{2}\d?)"
_CLOCK = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
_ZONE = r"(?:[Zz]|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?"
_HEAD = rf"^(?:{_DAY}|{_WEEK})"
ISO_SHAPE = rf"^(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}}|{_WEEK})(?:.{_CLOCK}{_ZONE})?$"


def _week_day(digits: Column) -> Column:
    """The day of year, week and weekday as seven digits, as eight digits; null if there is none."""
    year, week, day = (
        F.substring(digits, first, count).try_cast("int") for first, count in ((1, 4), (5, 2), (7, 1))
    )
    # Week 1 holds January 4; a week belongs to the year of its Thursday.
    fourth = F.concat(F.substring(digits, 1, 4), F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    found = F.when((F.year(F.date_add(monday, 3)) == year) & day.between(1, 7), F.date_add(monday, day - 1))
    return F.regexp_replace(found.cast("string"), "-", "")


def parse_iso(value: Column | str) -> Column:
    """Wall-clock time of an ISO text, whose day may be given by week and weekday (the Monday, if
    there is none); null for anything else. An offset is ignored."""
    value = as_column(value).cast("string")
    head = F.regexp_replace(F.regexp_extract(value, _HEAD, 0), "-", "")
    by_week = F.rpad(F.regexp_replace(head, "W", ""), 7, "1")
    day = F.when(F.substring(head, 5, 1) == "W", _week_day(by_week)).otherwise(head)
    clock = F.regexp_replace(F.regexp_extract(value, rf"{_HEAD}.{_CLOCK}", 0), rf"{_HEAD}.", "")
    digits = F.rpad(F.regexp_replace(F.regexp_replace(clock, "[.,].*$", ""), ":", ""), 6, "0")
    fraction = F.rpad(F.regexp_extract(clock, r"[.,](\d+)$", 1), 6, "0")
    iso = F.concat(
        F.substring(day, 1, 4), F.lit("-"), F.substring(day, 5, 2), F.lit("-"),
        F.substring(day, 7, 2), F.lit(" "), F.substring(digits, 1, 2), F.lit(":"),
        F.substring(digits, 3, 2), F.lit(":"), F.substring(digits, 5, 2), F.lit("."), fraction,
    )
    return F.when(value.rlike(ISO_SHAPE), iso.try_cast("timestamp_ntz"))


def month_of(date: Column | str) -> Column:
    """``yyyy-MM``, cut from the text form: formatting would pass through the session zone."""
    return F.substring(as_column(date).cast("string"), 1, 7)


def to_seconds_text(date: Column | str) -> Column:
    return F.substring(as_column(date).cast("string"), 1, 19)


def month_end(date: Column | str) -> Column:
    return F.last_day(as_column(date))


def day_part(hour: Column | str) -> Column:
    first, last = fixed.EVENING_HOURS
    return F.when(as_column(hour).between(first, last), fixed.EVENING_NAME).otherwise(
        fixed.OTHER_TIME_NAME
    )
