"""Helpers for time columns that may be ``timestamp`` or ``timestamp_ntz``.

Days and buckets are those of UTC, whatever the session's time zone: an instant is counted in microseconds since 1970, a
wall clock is taken as it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAY = 86_400_000_000
_STEP = {"minute": 60_000_000, "hour": 3_600_000_000, "day": _DAY}


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def utc_date(time: Column, dtype: T.DataType) -> Column:
    """The UTC day of an instant, or the day of a wall clock."""
    if isinstance(dtype, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(time) / F.lit(_DAY)).cast("int"))
    return time.cast("date")


def utc_wall(time: Column, dtype: T.DataType) -> Column:
    """The UTC wall clock of an instant as ``timestamp_ntz``; a wall clock stays as it is."""
    if not isinstance(dtype, T.TimestampType):
        return time
    # whole seconds and the rest apart: the seconds of an interval have 18 digits
    us = F.unix_micros(time)
    secs = (F.pmod(us, F.lit(_DAY)).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.floor(us / F.lit(_DAY)).cast("int"), F.lit(0), F.lit(0), secs)


def utc_text(time: Column, dtype: T.DataType) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` of the UTC wall clock."""
    text = utc_wall(time, dtype).cast("string")
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def bucket_of(df: DataFrame, unit: str = "minute", name: str = "time") -> Column:
    """The start of the UTC ``unit`` (minute, hour or day) that ``name`` is in, of the column's type."""
    c, dtype = F.col(name), type_of(df, name)
    if isinstance(dtype, T.TimestampType):
        us = F.unix_micros(c)
        return F.timestamp_micros(us - F.pmod(us, F.lit(_STEP[unit])))
    if unit == "day":
        return c.cast("date").cast(dtype)
    minutes = F.minute(c) if unit == "hour" else F.lit(0)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.expr(f"cast(extract(SECOND FROM `{name}`) as decimal(18,6))"))
