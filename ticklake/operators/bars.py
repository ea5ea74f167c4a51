"""Minute bars: last price per bucket, log returns, bucket means, calendar spine."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.timecols import bucket_of, type_of, utc_date
from ticklake.operators.ordered import lag_chunked


def last_price_bars(ticks: DataFrame, unit: str = "minute") -> DataFrame:
    """``product_id, bucket, price``: price of the latest tick in each bucket.

    Latest is by ``(time, sequence)``; ticks without a price are skipped.
    Aggregates map-side, so at most one row per symbol and bucket is shuffled.
    """
    b = bucket_of(ticks, unit)
    order = F.when(F.col("price").isNotNull(), F.struct("time", "sequence"))
    return (ticks.where(F.col("time").isNotNull())
            .groupBy("product_id", b.alias("bucket"))
            .agg(F.max_by("price", order).alias("price")))


def log_returns(bars: DataFrame, value: str = "price", out: str = "return") -> DataFrame:
    """``ln(p_t / p_{t-1})`` between consecutive non-empty buckets of a symbol.

    The previous bucket is found per (symbol, day) with a fix-up across day
    edges, so no symbol's whole history lands in one task. A non-positive
    price gives NULL.
    """
    day = bucket_of(bars, "day", "bucket")
    with_prev = lag_chunked(bars, ["product_id"], day, ["bucket"], [value], prefix="_prev_")
    p, q = F.col(value), F.col("_prev_" + value)
    ret = F.when((p > 0) & (q > 0), F.ln(p / q))
    return with_prev.withColumn(out, ret).drop("_prev_" + value)


def bucket_means(ticks: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("product_id",),
                 unit: str = "minute") -> DataFrame:
    """Mean of ``columns`` per key and bucket; empty buckets do not appear."""
    b = bucket_of(ticks, unit)
    return (ticks.groupBy(*keys, b.alias("bucket"))
            .agg(*[F.avg(c).alias(c) for c in columns]))


def with_calendar(means: DataFrame, keys: Sequence[str] = ("product_id",),
                  unit: str = "minute") -> DataFrame:
    """Add the empty buckets between each key's first and last bucket of a UTC day (as NULLs).

    The spine is generated per key and day from that day's own min/max, so
    that an array has the buckets of one day at most, whatever the range.
    """
    keys = list(keys)
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    day = utc_date(F.col("bucket"), type_of(means, "bucket"))
    spine = (means.groupBy(*keys, day.alias("_day"))
             .agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"))
             .select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias("bucket")))
    return spine.join(means, on=keys + ["bucket"], how="left")

