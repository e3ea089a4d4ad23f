"""Column rules for local time, UTC time and calendar keys.

Times are ``timestamp_ntz``: a reading carries its own zone code, so the Spark
session zone must not take part. Functions that would cast to the session zone
(``date_format``, ``date_trunc``, ``timestamp_diff``) are avoided for that reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.functions import fixed_values as fv


def as_time(col: Column) -> Column:
    """Time text of the form ``yyyy-MM-dd HH:mm:ss`` to ``timestamp_ntz``; blank
    or other text is null. Times so have no fraction of a second."""
    return F.when(F.length(col) == 19, col.try_cast("timestamp_ntz"))


def as_date(col: Column) -> Column:
    """Date of the first ten characters of a time text; bad text is null."""
    return F.substring(col, 1, 10).try_cast("date")


def time_text(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.substring(col.cast("string"), 1, 19)


def zone_minutes(zone: Column) -> Column:
    """Minutes east of UTC for a zone code; null for an unknown code."""
    offsets = F.array(*[F.lit(int(h * 60)) for h in fv.ZONE_OFFSET_HOURS])
    return F.get(offsets, zone.try_cast("int"))


def to_utc(local: Column, zone: Column) -> Column:
    return F.timestamp_add("MINUTE", -zone_minutes(zone), local)


def to_local(utc: Column, zone: Column) -> Column:
    return F.timestamp_add("MINUTE", zone_minutes(zone), utc)


def date_key(utc: Column) -> Column:
    """``yyyyMMdd``; null for a missing time (sinks write it as empty text)."""
    return F.translate(utc.cast("date").cast("string"), "-", "")


def iso_year(day: Column) -> Column:
    return F.date_part(F.lit("YEAROFWEEK"), day).cast("int")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def week_key(utc: Column) -> Column:
    """ISO year followed by the ISO week without zero padding."""
    return F.concat(iso_year(utc).cast("string"), iso_week(utc).cast("string"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, days included."""
    span = end - start
    part = lambda unit: F.extract(F.lit(unit), span).cast("long")
    return (
        part("DAY") * 86_400 + part("HOUR") * 3_600 + part("MINUTE") * 60 + part("SECOND")
    )


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, days included."""
    return F.floor(seconds_between(start, end) / 60)
