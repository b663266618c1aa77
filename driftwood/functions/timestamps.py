"""Timestamp parsing and differences (SCL-1/2/3/18, PRJ-7/8/9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The glued "date+time" text form of call records and the
# textual timestamp form "Day dd Mon yyyy hh:mm:ss +hhmm".
GLUED_DATETIME = r"(\d{4}-\d{2}-\d{2})(\d{2}:\d{2}:\d{2})"
OFFSET_TIMESTAMP_FORMAT = "d MMM yyyy HH:mm:ss xx"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_utc_timestamp_col(c: Column | str) -> Column:
    """TIMESTAMP_NTZ (wall clock) -> TIMESTAMP instant, read as UTC.

    Watermarks and ``unix_*`` functions need TIMESTAMP; the session zone is
    UTC so the cast keeps the wall-clock value.
    """
    return _c(c).cast("timestamp")


def repair_glued_datetime(c: Column | str) -> Column:
    """``2021-04-0212:23:10`` -> ``2021-04-02 12:23:10``; other text unchanged."""
    return F.regexp_replace(_c(c), GLUED_DATETIME, "$1 $2")


def parse_offset_timestamp(c: Column | str) -> Column:
    """``Sun 10 May 2015 13:54:36 -0700`` -> instant; null when unparsable.

    The day name is not checked (it is dropped), one-digit days and ``-0000``
    parse. Pure UTC arithmetic: no host zone is involved.
    """
    body = F.regexp_replace(F.trim(_c(c)), r"^\S+\s+", "")
    return F.try_to_timestamp(body, F.lit(OFFSET_TIMESTAMP_FORMAT))


def epoch_seconds(c: Column | str) -> Column:
    """Whole epoch seconds of a TIMESTAMP."""
    return F.unix_seconds(_c(c))


def micros_between(later: Column | str, earlier: Column | str) -> Column:
    """Exact difference in microseconds (``later - earlier``)."""
    return F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))


def timestamp_diff(t1: Column | str, t2: Column | str) -> Column:
    """Absolute difference of two instants in whole seconds (long)."""
    return F.abs(F.unix_seconds(_c(t1)) - F.unix_seconds(_c(t2)))
