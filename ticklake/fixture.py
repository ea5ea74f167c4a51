"""Ticks derived from the driver's ``events`` table (FIXTURES.md §4).

The same mapping is written as SQL in ``__spark_entry__.oracle_sql``; both
sides must stay equal. ``time`` stays ``timestamp_ntz`` like ``events.ts``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schema import TICK_COLUMNS, TICKER_TYPE


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("double")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` rows to tick rows (one tick per event, no shuffle)."""
    # k and price are computed once in their own projection (a JSON parse is
    # not cheap, so Catalyst keeps the projection instead of inlining it).
    events = events.select("event_id", "ts", "event_type",
                           (F.col("value") + F.lit(100.0)).alias("_px"), _k().alias("_k"))
    k, price = F.col("_k"), F.col("_px")
    cols = {
        "type": F.lit(TICKER_TYPE),
        "sequence": F.col("event_id"),
        "product_id": F.col("event_type"),
        "price": price,
        "open_24h": price,
        "volume_24h": k,
        "low_24h": price - F.lit(1.0),
        "high_24h": price + F.lit(1.0),
        "volume_30d": k * F.lit(30.0),
        "best_bid": price - F.lit(0.01) * (k + F.lit(1.0)),
        "best_bid_size": k + F.lit(1.0),
        "best_ask": price + F.lit(0.01) * (k + F.lit(1.0)),
        "best_ask_size": F.lit(100.0) - k,
        "last_size": k,
        "side": F.when(F.col("event_id") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell")),
        "time": F.col("ts"),
        "trade_id": F.col("event_id"),
        "recieved": F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 5).cast("decimal(18,6)")),
    }
    # Columns that filters prune by are plain ones; the others come out of one generated struct. Constraints that
    # Catalyst infers multiply with each alias of one expression, and planning would take most of the time.
    plain = ["sequence", "product_id", "time"]
    rest = F.struct(*[cols[c].alias(c) for c in TICK_COLUMNS if c not in plain])
    out = events.select(*[cols[c].alias(c) for c in plain], F.inline(F.array(rest))).select(*TICK_COLUMNS)
    return (out.withColumn("year", F.year("time"))
               .withColumn("month", F.month("time"))
               .withColumn("day", F.dayofmonth("time")))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def fixture_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(load_events(spark, sf_dir))


def messages_from_events(events: DataFrame, corrupt: bool = True) -> DataFrame:
    """``key, value`` feed messages made from the fixture ticks (FIXTURES.md §5).

    With ``corrupt``, by ``event_id``: mod 97 cut-off JSON; mod 89 ``price``
    ``"x"``; mod 83 ``time`` ``"never"``; mod 79 no ``time``; mod 73
    ``sequence`` ``"abc"``; mod 101 ``type`` ``subscriptions``.
    """
    from ticklake.sources.sinks import to_messages

    ticks = ticks_from_events(events)
    eid = F.col("sequence")
    if not corrupt:
        return to_messages(ticks).select("key", "value")
    ticks = (ticks.withColumn("type", F.when(eid % 101 == 0, F.lit("subscriptions"))
                              .otherwise(F.col("type")))
                  .withColumn("time", F.when(eid % 79 == 0, F.lit(None)).otherwise(F.col("time"))))
    msgs = to_messages(ticks.withColumn("_id", eid), extra=("_id",))
    # one step per rule, each over the previous column (no nested copies)
    rules = [
        (89, lambda v: F.regexp_replace(v, r'"price":"[^"]*"', '"price":"x"')),
        (83, lambda v: F.regexp_replace(v, r'"time":"[^"]*"', '"time":"never"')),
        (73, lambda v: F.regexp_replace(v, r'"sequence":[0-9]+', '"sequence":"abc"')),
        (97, lambda v: F.substring(v, 1, (F.length(v) / 2).cast("int"))),
    ]
    for mod, fix in rules:
        v = F.col("value")
        msgs = msgs.withColumn("value", F.when(F.col("_id") % mod == 0, fix(v)).otherwise(v))
    return msgs.select("key", "value")
