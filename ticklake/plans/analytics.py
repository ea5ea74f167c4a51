"""Q1-Q11, Q19: the query API over a tick DataFrame.

Every function takes a tick frame (``scan_ticks`` or any frame with the tick
columns plus ``year/month/day``) and returns a lazy ``DataFrame``. ``as_of``
stands in for "now" so results are reproducible.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from typing import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.params import (
    timeframe_bounds, ts_literal, validate_symbol, validate_symbols,
)
from ticklake.functions.timecols import type_of
from ticklake.operators.bars import last_price_bars, log_returns
from ticklake.operators.quantiles import long_values, summary
from ticklake.schema import NUMERIC_COLUMNS, TICK_COLUMNS
from ticklake.sources.scan import scan_day, scan_range

DayArg = date | datetime | str | tuple


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def tick_slice(ticks: DataFrame, day: DayArg, symbols=None) -> DataFrame:
    """One day, or an inclusive ``(first_day, last_day)`` range, of some symbols."""
    if isinstance(day, tuple):
        return scan_range(ticks, day[0], day[1], symbols)
    return scan_day(ticks, day, symbols)


def _window(ticks: DataFrame, symbols, timeframe: str, as_of) -> DataFrame:
    start, end = timeframe_bounds(as_of or _now(), timeframe)
    dtype = type_of(ticks, "time")
    return (scan_day(ticks, end, symbols)
            .where(F.col("time").between(ts_literal(start, dtype), ts_literal(end, dtype))))


def _vwap_expr():
    return F.try_divide(F.sum(F.col("price") * F.col("last_size")), F.sum("last_size"))


# Q1
def high_low(ticks: DataFrame, symbol, timeframe: str = "day", as_of=None) -> DataFrame:
    """``product_id, timeframe, low, high`` over the look-back window."""
    syms = validate_symbols(symbol)
    return (_window(ticks, syms, timeframe, as_of)
            .groupBy("product_id")
            .agg(F.min("price").alias("low"), F.max("price").alias("high"))
            .select("product_id", F.lit(timeframe).alias("timeframe"), "low", "high")
            .na.drop())


# Q2
def latest_prices(ticks: DataFrame, symbol, limit: int = 10, as_of=None) -> DataFrame:
    """The ``limit`` latest ticks of the day: ``product_id, price, recieved``.

    ``row_number() <= limit`` plans as a partial + final ``WindowGroupLimit``:
    each map task keeps ``limit`` rows per symbol before the shuffle.
    """
    syms = validate_symbols(symbol)
    day = (as_of or _now())
    w = Window.partitionBy("product_id").orderBy(F.col("time").desc(), F.col("sequence").desc())
    return (scan_day(ticks, day, syms)
            .select("product_id", "price", "recieved", F.row_number().over(w).alias("rn"))
            .where(F.col("rn") <= int(limit))
            .drop("rn")
            .na.drop())


# Q3
def quickvwap(ticks: DataFrame, day: DayArg = None) -> DataFrame:
    """Per symbol for the day: ``cumulative_volume`` (3 dp) and ``vwap`` (2 dp)."""
    return (tick_slice(ticks, day or _now())
            .groupBy("product_id")
            .agg(F.round(F.sum("last_size"), 3).alias("cumulative_volume"),
                 F.round(_vwap_expr(), 2).alias("vwap")))


# Q4
def vwap(ticks: DataFrame, symbol, timeframe: str = "day", as_of=None) -> DataFrame:
    """``product_id, timeframe, vwap`` over the look-back window (not rounded)."""
    syms = validate_symbols(symbol)
    return (_window(ticks, syms, timeframe, as_of)
            .groupBy("product_id")
            .agg(_vwap_expr().alias("vwap"))
            .select("product_id", F.lit(timeframe).alias("timeframe"), "vwap")
            .na.drop())


# Q5
def returns(ticks: DataFrame, symbol=None, day: DayArg = None, unit: str = "minute") -> DataFrame:
    """``product_id, bucket, price, return``: last price per bucket and its log return."""
    syms = validate_symbols(symbol)
    bars = last_price_bars(tick_slice(ticks, day or _now(), syms), unit)
    return (log_returns(bars)
            .select("product_id", "bucket", "price", "return")
            .na.drop()
            .orderBy("product_id", "bucket"))


# Q6
def volatility(ticks: DataFrame, symbol=None, day: DayArg = None, unit: str = "minute") -> DataFrame:
    """``product_id, volatility``: sample std-dev of the bucket log returns."""
    syms = validate_symbols(symbol)
    bars = last_price_bars(tick_slice(ticks, day or _now(), syms), unit)
    return (log_returns(bars)
            .where(F.col("return").isNotNull())
            .groupBy("product_id")
            .agg(F.stddev_samp("return").alias("volatility"))
            .na.drop())


def _pearson(a: str, b: str):
    # corr() raises on a zero-variance input under ANSI mode; NULL instead.
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


# Q7
def correlation(ticks: DataFrame, symbol1: str, symbol2: str, day: DayArg = None,
                unit: str = "minute") -> DataFrame:
    """``product_id_a, product_id_b, correlation`` of the two return series.

    Each series' returns are computed on its own bars. A bucket that both have
    becomes one row with both returns, by a conditional aggregate: one scan, no join.
    """
    a, b = validate_symbol(symbol1), validate_symbol(symbol2)
    bars = last_price_bars(tick_slice(ticks, day or _now(), [a, b]), unit)
    rets = log_returns(bars).where(F.col("return").isNotNull())
    both = rets.groupBy("bucket").agg(*[F.max(F.when(F.col("product_id") == s, F.col("return"))).alias(n) for s, n in ((a, "ret_a"), (b, "ret_b"))])
    return (both.where(F.col("ret_a").isNotNull() & F.col("ret_b").isNotNull())
            .agg(_pearson("ret_a", "ret_b").alias("correlation"))
            .select(F.lit(a).alias("product_id_a"), F.lit(b).alias("product_id_b"), "correlation")
            .na.drop())


# Q8
def dataset(ticks: DataFrame, day: DayArg = None) -> DataFrame:
    """``product_id, row_count`` for the day, largest first."""
    return (tick_slice(ticks, day or _now())
            .groupBy("product_id")
            .agg(F.count("product_id").alias("row_count"))
            .orderBy(F.desc("row_count")))


# Q9
def vwap_on_date(ticks: DataFrame, symbol: str, day: DayArg) -> DataFrame:
    """``product_id, vwap`` of one symbol over a whole chosen day."""
    syms = validate_symbols(symbol)
    return (tick_slice(ticks, day, syms)
            .groupBy("product_id")
            .agg(_vwap_expr().alias("vwap"))
            .na.drop())


# Q10
def symbols_on_date(ticks: DataFrame, day: DayArg) -> DataFrame:
    """Distinct ``product_id`` present on a day."""
    return tick_slice(ticks, day).select("product_id").distinct()


# Q11
def day_extract(ticks: DataFrame, day: DayArg, symbols=None) -> DataFrame:
    """All tick columns of a day (and symbols); rows with any NULL/NaN dropped."""
    cols = [c for c in TICK_COLUMNS] + [c for c in ("year", "month", "day") if c in ticks.columns]
    return tick_slice(ticks, day, symbols).select(*cols).na.drop("any")


DESCRIBE_COLUMNS = ["sequence", *NUMERIC_COLUMNS, "trade_id"]


# Q19
def describe_ticks(ticks: DataFrame, day: DayArg, symbols=None,
                   columns: Iterable[str] = DESCRIBE_COLUMNS, exact: bool = True,
                   accuracy: int = 100000) -> DataFrame:
    """Per symbol and numeric column: count, mean, std, min, quartiles, max.

    ``exact`` quartiles interpolate linearly between order statistics like
    pandas; they and the moments come from ``operators.quantiles.summary`` in
    two passes. ``exact=False`` takes one pass and ``percentile_approx``.
    """
    df, cols = day_extract(ticks, day, symbols), list(columns)
    names = ["p25", "p50", "p75"]
    if exact:
        return summary(df, ["product_id"], cols, [0.25, 0.5, 0.75], names)
    q = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
    return (long_values(df, ["product_id"], cols).groupBy("product_id", "column")
            .agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                 F.min("value").alias("min"), q.alias("_q"), F.max("value").alias("max"))
            .select("product_id", "column", "count", "mean", "std", "min", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], "max"))
