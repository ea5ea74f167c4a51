"""Query parameters: symbol validation, look-back windows, typed literals."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.schema import SYMBOL_PATTERN, TIMEFRAME_MINUTES

_SYMBOL_RE = re.compile(SYMBOL_PATTERN)


def validate_symbol(symbol: str) -> str:
    """Raise ``ValueError`` unless ``symbol`` fully matches the symbol pattern."""
    if not isinstance(symbol, str) or not _SYMBOL_RE.fullmatch(symbol):
        raise ValueError(f"INVALID SYMBOL {symbol}")
    return symbol


def validate_symbols(symbols: str | Iterable[str] | None) -> list[str] | None:
    """``None`` means all symbols; a string or an iterable is validated."""
    if symbols is None:
        return None
    if isinstance(symbols, str):
        return [validate_symbol(symbols)]
    return [validate_symbol(s) for s in symbols]


def symbols_predicate(symbols: list[str] | None) -> Column:
    """Equality or IN on ``product_id``; pushed to the scan / partition filter."""
    if symbols is None:
        return F.lit(True)
    if len(symbols) == 1:
        return F.col("product_id") == F.lit(symbols[0])
    return F.col("product_id").isin(symbols)


def _as_datetime(value: datetime | date | str) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value))


def timeframe_bounds(as_of: datetime | str, timeframe: str) -> tuple[datetime, datetime]:
    """Start and end of a look-back window ending at ``as_of``.

    ``1h``/``30m``/``15m``/``5m`` look back that long; anything else means
    since midnight of ``as_of``'s day.
    """
    end = _as_datetime(as_of)
    minutes = TIMEFRAME_MINUTES.get(timeframe)
    if minutes is None:
        start = end.replace(hour=0, minute=0, second=0, microsecond=0)
    else:
        start = end - timedelta(minutes=minutes)
    return start, end


def day_bounds(day: datetime | date | str) -> tuple[datetime, datetime]:
    """[midnight, next midnight) of a calendar day."""
    d = _as_datetime(day).replace(hour=0, minute=0, second=0, microsecond=0)
    return d, d + timedelta(days=1)


def ts_literal(value: datetime | date | str, dtype: T.DataType) -> Column:
    """A timestamp literal of the same type as the column it is compared with.

    ``value`` is UTC if it says no zone, whatever the session's time zone.
    """
    moment = _as_datetime(value)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit((moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)))
    return F.lit(moment.isoformat(sep=" ")).cast(dtype)
