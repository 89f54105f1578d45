"""Textual review dates to epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English and Spanish month names.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7,
    "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "ene": 1, "abr": 4, "ago": 8, "dic": 12,
}


def parse_review_time(raw: Column, now: Column) -> Column:
    """``today at H:M``, ``yesterday at H:M`` or ``D Mon YYYY`` as epoch seconds, else null.

    ``now`` is a timestamp column, so reruns agree; the zone is the session's.
    """
    text = F.trim(F.regexp_replace(F.lower(F.trim(raw)), "^last updated:", ""))
    clock = r"^(today|yesterday) at\s*(\d{1,2})\s*:\s*(\d{1,2})$"
    day = r"^(\d{1,2})\s+([a-z]+)\s+(\d{1,4})$"
    base = F.to_date(now)
    when_day = F.when(F.regexp_extract(text, clock, 1) == "yesterday", F.date_sub(base, 1)).otherwise(base)
    hour = F.regexp_extract(text, clock, 2).try_cast("int")
    minute = F.regexp_extract(text, clock, 3).try_cast("int")
    at_clock = F.unix_timestamp(F.try_make_timestamp(
        F.year(when_day), F.month(when_day), F.day(when_day), hour, minute, F.lit(0)
    ))
    month = None
    for name, number in MONTHS.items():
        hit = F.regexp_extract(text, day, 2) == name
        month = F.when(hit, number) if month is None else month.when(hit, number)
    at_day = F.unix_timestamp(F.try_make_timestamp(
        F.regexp_extract(text, day, 3).try_cast("int"), month,
        F.regexp_extract(text, day, 1).try_cast("int"), F.lit(0), F.lit(0), F.lit(0)
    ))
    return F.when(text.rlike(clock), at_clock).when(text.rlike(day), at_day)
