"""Time and unit helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: time-of-day patterns with 0 to 6 fraction digits; the day is 1900-01-01 ---
CLOCK = r"^\d{1,2}:\d{2}:\d{2}(\.\d{1,6})?$"
CLOCK_DAY = "1900-01-01 "
CLOCK_FORMAT = "yyyy-MM-dd H:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"


def parse_sample_time(text: Column) -> Column:
    """``H:M:S`` or ``H:M:S.f`` on 1900-01-01, else a full timestamp, else null.

    The choice is made per value: a file in one format reads the same as with
    a per-file choice, and a mixed file keeps all its rows.
    """
    trimmed = F.trim(text)
    clock = F.try_to_timestamp(F.concat(F.lit(CLOCK_DAY), trimmed), F.lit(CLOCK_FORMAT))
    parsed = F.when(trimmed.rlike(CLOCK), clock).otherwise(F.try_to_timestamp(trimmed))
    return parsed.cast("timestamp_ntz")


def report_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def seconds_from_nanos(nanos: Column) -> Column:
    return nanos / F.lit(1e9)


def millis(seconds: Column) -> Column:
    return seconds * 1000


def lag_seconds(produced: Column, now: Column) -> Column:
    """Seconds from a record's time to ``now``; 0 for a missing or negative record time."""
    produced_ms = F.unix_millis(produced.cast("timestamp"))
    lag = (F.unix_millis(now.cast("timestamp")) - produced_ms) / 1000.0
    return F.when(produced_ms >= 0, lag).otherwise(F.lit(0.0))
