"""Time conversions and formats (all JVM-side expressions).

Event time inside the library is a Spark ``TimestampType`` column read
with the session zone pinned to UTC. Window bounds leave the library as
BIGINT epoch seconds, which compare equal across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_to_ts(c) -> Column:
    """Epoch seconds (long) -> timestamp."""
    return F.timestamp_seconds(col_(c))


def millis_to_ts(c) -> Column:
    """Epoch milliseconds (long) -> timestamp."""
    return F.timestamp_millis(col_(c))


def as_instant(c) -> Column:
    """TIMESTAMP_NTZ (wall clock in UTC) or TIMESTAMP -> TIMESTAMP.

    ``withWatermark`` and ``unix_micros`` refuse TIMESTAMP_NTZ, so every
    reader funnels its time column through here.
    """
    return col_(c).cast("timestamp")


def epoch_micros(c) -> Column:
    return F.unix_micros(col_(c))


def epoch_seconds(c) -> Column:
    return F.unix_seconds(col_(c))


def floor_div(num: Column, den: int) -> Column:
    """Integral floor division for longs (also right for negative numerators).

    The numerator is first made an exact multiple of ``den``; the quotient
    is exact for |num| < 2**53 (epoch microseconds until the year 2255)."""
    return ((num - F.pmod(num, F.lit(den))) / F.lit(den)).cast("long")


def format_local(c, tz: str = "+08:00", pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Render an instant as wall-clock text at a fixed offset or zone."""
    return F.date_format(F.from_utc_timestamp(col_(c), tz), pattern)


def format_java_timestamp(c, tz: str = "UTC") -> Column:
    """``java.sql.Timestamp.toString`` form: seconds, then '.', then the
    fraction without trailing zeros ('0' when the fraction is zero)."""
    local = F.from_utc_timestamp(col_(c), tz)
    frac = F.regexp_replace(F.date_format(local, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def next_midnight(c, tz: str = "UTC") -> Column:
    """Start of the next calendar day of ``c`` in zone ``tz`` (as an instant)."""
    local = F.from_utc_timestamp(col_(c), tz)
    return F.to_utc_timestamp(F.date_trunc("day", local) + F.expr("INTERVAL 1 DAY"), tz)


def day_index(c, tz: str = "UTC") -> Column:
    """Calendar day of ``c`` in zone ``tz`` as a date (a grouping key)."""
    return F.to_date(F.from_utc_timestamp(col_(c), tz))
