"""Q12-Q18: the volatility-event and sequence-gap reports, one plan for all symbols.

The reports work per symbol and day. Minute means are aggregated map-side, so
the windows below see at most one row per symbol-minute; the raw-tick
sequence window is chunked (``lag_chunked``) so a hot symbol is spread over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.timecols import bucket_of, type_of, utc_date
from ticklake.operators.bars import bucket_means, with_calendar
from ticklake.operators.ordered import lag_chunked
from ticklake.plans.analytics import DESCRIBE_COLUMNS, DayArg, day_extract
from ticklake.schema import LEVEL_NAMES_ABOVE_NORMAL, VOLATILITY_LEVELS, ZERO_GAP

MEAN_COLUMNS = DESCRIBE_COLUMNS
# A symbol-day: the partition keys of the tick table.
SYMBOL_DAY = ["product_id", "year", "month", "day"]


# Q12
def resample_mean(ticks: DataFrame, day: DayArg, symbols=None, dense: bool = False,
                  unit: str = "minute") -> DataFrame:
    """Mean of every numeric column per symbol and minute of the cleaned day.

    ``dense=False`` drops empty minutes; ``dense=True`` keeps them as NULL rows
    between each symbol's first and last minute of a day; the nights between two days stay empty.
    """
    clean = day_extract(ticks, day, symbols)
    means = bucket_means(clean, MEAN_COLUMNS, ("product_id",), unit)
    return with_calendar(means, ("product_id",), unit) if dense else means


def _level_name(code):
    expr = F.when(code == 1, VOLATILITY_LEVELS[1])
    for k in (2, 3, 4):
        expr = expr.when(code == k, VOLATILITY_LEVELS[k])
    return expr


# Q13
def volatility_levels(ticks: DataFrame, day: DayArg, symbols=None) -> DataFrame:
    """Per symbol-minute: level of |Δ last_size| against the day's σ of last_size.

    ≤σ NORMAL(1), ≤2σ HIGH(2), ≤3σ VERY_HIGH(3), >3σ EXTREME(4); no Δ or no σ
    is NORMAL. Columns: ``symbol, bucket, price, last_size, level, volatility_level``.
    """
    means = resample_mean(ticks, day, symbols)
    means = means.withColumn("trade_date", utc_date(F.col("bucket"), type_of(means, "bucket")))
    part = Window.partitionBy("product_id", "trade_date")
    sigma = F.stddev_samp("last_size").over(part)
    delta = F.abs(F.col("last_size") - F.lag("last_size").over(part.orderBy("bucket")))
    level = (F.when(delta <= sigma, 1).when(delta <= 2 * sigma, 2)
             .when(delta <= 3 * sigma, 3).when(delta > 3 * sigma, 4).otherwise(1))
    return (means.select(F.col("product_id").alias("symbol"), "bucket", "price", "last_size",
                         level.alias("level"))
            .withColumn("volatility_level", _level_name(F.col("level"))))


# Q14
def volatility_events(ticks: DataFrame, day: DayArg, symbols=None) -> DataFrame:
    """Minutes at HIGH or above: ``symbol, bucket, price, last_size, volatility_level``."""
    return (volatility_levels(ticks, day, symbols)
            .where(F.col("level") >= 2)
            .select("symbol", "bucket", "price", "last_size", "volatility_level"))


# Q15
def volatility_crosstab(ticks: DataFrame, day: DayArg, symbols=None) -> DataFrame:
    """Event counts, symbol x level (``HIGH``, ``VERY_HIGH``, ``EXTREME``)."""
    return (volatility_events(ticks, day, symbols)
            .groupBy("symbol")
            .pivot("volatility_level", LEVEL_NAMES_ABOVE_NORMAL)
            .count()
            .na.fill(0, LEVEL_NAMES_ABOVE_NORMAL))


# Q16
def sequence_gaps(ticks: DataFrame, day: DayArg, symbols=None,
                  chunk_width: int = 1 << 20) -> DataFrame:
    """Rows in ``sequence`` order with ``ordering`` = gap to the previous row.

    A zero gap becomes 0.001; the first row of a symbol-day has none;
    ``log_ordering = ln(ordering)``. The lag runs per (symbol, day,
    sequence // chunk_width) so no symbol is a single task.
    """
    clean = day_extract(ticks, day, symbols)
    chunk = F.floor(F.col("sequence") / F.lit(chunk_width))
    prev = lag_chunked(clean, SYMBOL_DAY, chunk, ["sequence", "time", "trade_id"], ["sequence"],
                       prefix="_prev_")
    gap = (F.col("sequence") - F.col("_prev_sequence")).cast("double")
    ordering = F.when(gap == 0, F.lit(ZERO_GAP)).otherwise(gap)
    return (prev.withColumn("ordering", ordering)
            .withColumn("log_ordering", F.ln("ordering"))
            .drop("_prev_sequence"))


# Q17
def mean_gap(ticks: DataFrame, day: DayArg, symbols=None) -> DataFrame:
    """``product_id, year, month, day, mean_ordering``: mean gap per symbol-day."""
    return (sequence_gaps(ticks, day, symbols)
            .groupBy(*SYMBOL_DAY)
            .agg(F.avg("ordering").alias("mean_ordering")))


# Q18
def gap_series(ticks: DataFrame, day: DayArg, symbols=None, unit: str = "minute") -> DataFrame:
    """Per-minute mean of ``ordering`` and ``log_ordering``, empty minutes kept as NULL."""
    gaps = sequence_gaps(ticks, day, symbols)
    b = bucket_of(gaps, unit)
    means = (gaps.groupBy("product_id", b.alias("bucket"))
             .agg(F.avg("ordering").alias("ordering"), F.avg("log_ordering").alias("log_ordering")))
    return with_calendar(means, ("product_id",), unit)
