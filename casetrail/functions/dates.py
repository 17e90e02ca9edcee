"""Date cleaning for staging, and the date texts of event records.

Every text parse is guarded by a shape first: a bare cast would read ``2020`` or ``05:00``
as a timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import is_instant
from .culture import written_instant
from .text import attribute_text, strip

# The shapes and bounds that decide which values count as dates.
DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?(?:[+-]\d{2}(?::?\d{2})?)?)?\z"
OFFSET_TAIL = r"[T ][^+-]+[+-]\d{2}(?::?\d{2})?\z"
EARLIEST_EVENT_YEAR = 1900
SENTINEL_DAY = "1900-01-01"
CALENDAR_START = "1582-10-15"
DATE_TEXT = "yyyy-MM-dd"
UTC_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_instant(text: Column) -> Column:
    """Instant of ISO text, NULL for anything else."""
    return F.when(text.rlike(ISO_SHAPE), text.try_cast("timestamp"))


def read_instant(text: Column, day_first: bool = False) -> Column:
    """Instant of staged date text: ISO first, with or without a final Z, then the forms the source systems write."""
    trimmed = strip(text)
    return F.coalesce(iso_instant(F.regexp_replace(trimmed, r"Z\z", "")), written_instant(trimmed, day_first))


def has_offset(text: Column) -> Column:
    return text.rlike(OFFSET_TAIL)


def is_time_only(c: Column) -> Column:
    """A clock time without a date: a colon but none of ``- / T ,``."""
    t = strip(c)
    return t.contains(":") & ~t.rlike("[-/T,]")


def without_time_only(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    if not isinstance(dtype, T.StringType):
        return c
    return F.when(~is_time_only(c), c)


def useful_value(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """The value unless it is blank or a bare clock time."""
    if not isinstance(dtype, T.StringType):
        return c
    return F.when(~is_time_only(c) & (strip(c) != ""), c)


def to_second(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Timestamp rounded to the whole second, NULL where the value is no date."""
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    stamp = c if is_instant(dtype) else read_instant(c)
    rounded = F.date_trunc("second", stamp.cast("timestamp") + F.expr("INTERVAL 500 MILLISECONDS"))
    return rounded.cast("timestamp_ntz") if isinstance(dtype, T.TimestampNTZType) else rounded


def clean_sentinel(c: Column, dtype: T.DataType = T.TimestampType()) -> Column:
    """NULL for the placeholder midnight and for days before the calendar's start."""
    kind = "date" if isinstance(dtype, T.DateType) else dtype.simpleString()
    placeholder = F.lit(SENTINEL_DAY).cast("date").cast(kind)
    start = F.lit(CALENDAR_START).cast("date").cast(kind)
    return F.when(~((c == placeholder) | (c < start)), c)


def on_or_after(c: Column, day: str) -> Column:
    """Cut-off by day. The bound is a midnight, so the column itself is compared and the
    filter reaches the scan."""
    return c >= F.lit(day).cast("timestamp_ntz")


def event_date(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """``YYYY-MM-DD`` of a value, NULL if invalid or too early."""
    if is_instant(dtype) or isinstance(dtype, T.DateType):
        return F.when(F.year(c) >= EARLIEST_EVENT_YEAR, F.date_format(c, DATE_TEXT))
    return date_of_text(strip(attribute_text(c, dtype)))


def event_datetime(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """UTC text ``YYYY-MM-DDTHH:MM:SSZ`` of a value.

    A bare ten-character date gets midnight with only its year checked; longer text must parse.
    An offset moves the time to UTC, fractions of a second are cut.
    """
    if is_instant(dtype) or isinstance(dtype, T.DateType):
        return F.when(F.year(c) >= EARLIEST_EVENT_YEAR, F.date_format(c, UTC_TEXT))
    return datetime_of_text(strip(attribute_text(c, dtype)))


def _dated(trimmed: Column) -> Column:
    """Begins like a date of a year that counts; no word for a missing value does."""
    return trimmed.rlike(DATE_PREFIX) & (F.substring(trimmed, 1, 4) >= str(EARLIEST_EVENT_YEAR))


def date_of_text(trimmed: Column) -> Column:
    day = F.substring(trimmed, 1, 10)
    return F.when(_dated(trimmed) & day.try_cast("date").isNotNull(), day)


def datetime_of_text(trimmed: Column) -> Column:
    parsed = F.date_format(iso_instant(F.regexp_replace(trimmed, r"Z\z", "")), UTC_TEXT)
    midnight = F.concat(trimmed, F.lit("T00:00:00Z"))
    return F.when(_dated(trimmed), F.when(F.length(trimmed) == 10, midnight).otherwise(parsed))


def runs_backwards(start: Column, end: Column, may_be_invalid: bool = True) -> Column:
    """True where the end lies before the start; texts that are no real time never do."""
    backwards = end < start
    if may_be_invalid:
        for side in (start, end):
            backwards = backwards & side.try_cast("timestamp").isNotNull()
    return F.coalesce(backwards, F.lit(False))
