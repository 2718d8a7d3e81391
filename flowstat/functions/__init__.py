"""Scalar column helpers.  All of them are built-in Spark expressions, so they
stay inside whole-stage codegen; nothing here is a Python UDF."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Static-asset suffixes dropped from page statistics.
ASSET_PATTERN = r"\.(css|js|png|ico)$"
# Multiplier and mask of the one-hash distinct-visitor bitmap (2^29 bits).
BITMAP_HASH_MULTIPLIER = 67
BITMAP_BITS = 1 << 29
# Time pattern of the access log's time field.
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
# ------------------------------------------------------------------------------

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def duration_us(d) -> int:
    """'5 minutes' / '1 hour' / timedelta / int seconds -> microseconds."""
    if isinstance(d, timedelta):
        return int(round(d.total_seconds() * 1_000_000))
    if isinstance(d, (int, float)):
        return int(round(d * 1_000_000))
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*", str(d))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"cannot parse duration {d!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def duration_str(us: int) -> str:
    """Microseconds -> a Spark interval string ('300 seconds')."""
    if us % 1_000_000 == 0:
        return f"{us // 1_000_000} seconds"
    return f"{us} microseconds"


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def ts_type(df: DataFrame, ts: str) -> T.DataType:
    dt = df.schema[ts].dataType
    if not isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"column {ts} must be a timestamp, not {dt.simpleString()}")
    return dt


def to_micros(col: Column | str, dtype: T.DataType) -> Column:
    """Event time -> epoch microseconds, independent of the session zone
    (a TIMESTAMP_NTZ is read as a UTC wall clock from its date and time
    fields, so no zone - and no daylight-saving shift - is involved)."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        secs = F.date_part(F.lit("SECOND"), c)                      # decimal(8,6): seconds with fraction
        return (F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000)
                + F.hour(c).cast("long") * F.lit(3_600_000_000)
                + F.minute(c).cast("long") * F.lit(60_000_000)
                + (secs * F.lit(1_000_000)).cast("long"))
    return F.unix_micros(c)


def from_micros(col: Column | str, dtype: T.DataType) -> Column:
    """Inverse of :func:`to_micros`, keeping the original timestamp flavour."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", c, _epoch_ntz())
    return F.timestamp_micros(c)


def floor_to(col: Column, step: int) -> Column:
    """Largest multiple of ``step`` <= col (exact integer arithmetic)."""
    return col - F.pmod(col, F.lit(step))


def ceil_to(col: Column, step: int) -> Column:
    return col + F.pmod(-col, F.lit(step))


def epoch_to_ts(col: Column | str, unit: str = "s") -> Column:
    """Epoch seconds / milliseconds (long) -> TIMESTAMP."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c) if unit == "ms" else F.timestamp_seconds(c)


def bitmap_hash(col: Column | str, multiplier: int = BITMAP_HASH_MULTIPLIER,
                bits: int = BITMAP_BITS) -> Column:
    """Polynomial hash ``h = h*multiplier + char`` of the decimal string of
    ``col``, kept below ``bits`` (a power of two) at every step so the long
    never overflows.  Masking commutes with multiply-add, so the value equals
    the unmasked 64-bit hash taken modulo ``bits``."""
    mask = bits - 1
    c = F.col(col) if isinstance(col, str) else col
    chars = F.split(c.cast("string"), "")
    return F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: (acc * F.lit(multiplier) + F.ascii(ch).cast("long")).bitwiseAND(F.lit(mask)))


def is_asset(url: Column | str, pattern: str = ASSET_PATTERN) -> Column:
    c = F.col(url) if isinstance(url, str) else url
    return c.rlike(pattern)


def to_utc_wallclock(col: Column | str, dtype: T.DataType) -> Column:
    """Event time -> TIMESTAMP_NTZ wall clock in UTC, whatever the session
    zone (an NTZ column is taken to be a UTC wall clock already)."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        return c
    return from_micros(F.unix_micros(c), T.TimestampNTZType())


def local_day(ts: Column | str, zone: str = "UTC", dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """Calendar day of an event time in ``zone`` (for daily resets); no
    dependence on the session zone."""
    wall = to_utc_wallclock(ts, dtype)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), wall).cast("date")


def fmt_ts(ts: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, pattern)


def json_long(col: Column | str, key: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, f"$.{key}").cast("long")
