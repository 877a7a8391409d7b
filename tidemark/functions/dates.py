"""Calendar arithmetic and date parsing as column expressions.

Times are ``timestamp_ntz`` throughout, so no result depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
ISO_SECONDS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
DAY_FIRST = r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$"


def at(moment: datetime) -> Column:
    """A run time given by the caller; never the wall clock of a task."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "MM")


def first_of_year(day: Column) -> Column:
    return F.trunc(day, "YYYY")


def last_of_month(day: Column) -> Column:
    return F.last_day(day)


def plus_months(day: Column, months: Column | int) -> Column:
    """Add months; the day is clamped to the length of the month reached."""
    return F.add_months(day, months)


def calendar_months(start: Column, end: Column) -> Column:
    """Whole calendar months from one date's month to the other's."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def to_minute(moment: Column) -> Column:
    """Seconds cut off.  Truncating by format would pass through the session time zone."""
    seconds = F.extract(F.lit("SECOND"), moment)
    zero = F.lit(0)
    return (moment - F.make_dt_interval(zero, zero, zero, seconds)).cast("timestamp_ntz")


def timestamp_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, further digits cut; a date is ``yyyy-MM-dd``."""
    text = moment.cast("string")
    full = F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.split_part(text, F.lit("."), F.lit(2)), 3, "0"))
    return F.when(F.typeof(moment) == "date", text).otherwise(full)


def parse_or_epoch(text: Column) -> Column:
    """Parse ``yyyy-MM-ddTHH:mm:ss``; anything else is 1970-01-01."""
    parsed = F.when(text.rlike(ISO_SECONDS), text.try_cast("timestamp_ntz"))
    return F.coalesce(parsed, at(EPOCH))


def day_first_to_iso(text: Column) -> Column:
    """Rewrite ``dd.MM.yyyy`` text as ``yyyy-MM-dd``; other text stays as it is."""
    pieces = [F.regexp_extract(text, DAY_FIRST, g) for g in (3, 2, 1)]
    iso = F.concat_ws("-", pieces[0], F.lpad(pieces[1], 2, "0"), F.lpad(pieces[2], 2, "0"))
    parsed = F.when(text.rlike(DAY_FIRST), iso.try_cast("date"))
    return F.coalesce(parsed.cast("string"), text)
