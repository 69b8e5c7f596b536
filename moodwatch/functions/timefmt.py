"""Time parsing, bucketing and labels (all UTC, all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwatch.functions.constants import CREATED_AT_FORMAT, HOUR_LABEL_FORMAT, HOUR_LABEL_FORMAT_12H


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_created_at(ts: str | Column) -> Column:
    """Render a UTC ``timestamp_ntz`` the way the source API sends ``created_at``."""
    return F.date_format(_c(ts), "EEE MMM dd HH:mm:ss '+0000' yyyy")


def parse_created_at(col: str | Column) -> Column:
    """``Sat Jan 18 20:03:51 +0800 2020`` -> UTC ``timestamp_ntz``; null when malformed.

    Spark's parser rejects a leading day-of-week field, so the first four
    characters are dropped; the offset in the text fixes the instant, and the
    instant is re-expressed as a zone-free UTC wall time so the result does not
    depend on the session time zone.
    """
    fmt = CREATED_AT_FORMAT.split(" ", 1)[1]
    instant = F.try_to_timestamp(F.substring(_c(col), 5, 1 << 20), F.lit(fmt))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def hour_bucket(ts: str | Column, clock12: bool = False) -> Column:
    """Start of the hour.  ``clock12`` reproduces the 12-hour key without AM/PM:
    08:xx and 20:xx of the same day share one bucket (stamped 08:00), noon and
    midnight both land on 00:00."""
    t = _c(ts)
    if not clock12:
        return F.date_trunc("hour", t).cast("timestamp_ntz")
    day = F.date_trunc("day", t).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.hour(t) % 12, day)


def hour_label(ts: str | Column, clock12: bool = False) -> Column:
    """``yyyy-MM-dd HH`` (``hh`` -- 01..12 -- with ``clock12``)."""
    return F.date_format(_c(ts), HOUR_LABEL_FORMAT_12H if clock12 else HOUR_LABEL_FORMAT)
