"""SNK1-SNK3: append ticks, write dead letters, encode ticks as feed messages."""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.timecols import type_of, utc_text
from ticklake.schema import (
    INTEGER_COLUMNS, NUMERIC_COLUMNS, PARTITION_COLUMNS, TICK_COLUMNS, TOPIC_PREFIX,
)
from ticklake.sources.layout import DAY_COLUMNS, WRITE_COLUMNS


# SNK1
def append_ticks(ticks: DataFrame, root: str, batch: str | None = None) -> None:
    """Write typed ticks under ``root`` as ``year=/month=/day=/batch=/product_id=``.

    ``batch`` names the write (a stream's batch id). With dynamic partition overwrite, writing the same ``batch`` again
    replaces exactly its own directories, and days for which a compaction has taken it in are left out, so a replayed
    micro-batch does not duplicate rows. Without a name, a unique one is made, so plain appends never replace each other.
    Rows are sorted by time within each file so Parquet min/max statistics prune time ranges.
    """
    from ticklake.sources.compaction import folded_days

    out = ticks.select(*TICK_COLUMNS, *DAY_COLUMNS)
    if not batch:
        batch = "a" + datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f") + os.urandom(3).hex()
    elif done := folded_days(ticks.sparkSession, root, batch):
        days = ticks.sparkSession.createDataFrame([(d.year, d.month, d.day) for d in done], "year int, month int, day int")
        out = out.join(days, DAY_COLUMNS, "left_anti")
    out = out.withColumn("batch", F.lit(batch))
    # REBALANCE: AQE groups rows by partition directory (few files per
    # directory) and splits a hot symbol-day over several tasks and files.
    (out.hint("rebalance", *PARTITION_COLUMNS)
        .sortWithinPartitions(*PARTITION_COLUMNS, "time", "sequence")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*WRITE_COLUMNS)
        .parquet(root))


# SNK2
def write_dead_letters(bad: DataFrame, root: str, batch: str) -> None:
    """Dead letters (``key, reason, value``) as JSON lines under ``root/batch=``."""
    (bad.withColumn("batch", F.lit(batch))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch").json(root))


# SNK3
def to_messages(ticks: DataFrame, topic_day=None, extra: tuple[str, ...] = ()) -> DataFrame:
    """``topic, key, value``: ticks as keyed JSON feed messages.

    Numbers travel as JSON strings (as the feed sends them), ``sequence`` and
    ``trade_id`` as integers, ``time`` as ISO-8601 UTC text and the receive
    stamp in its text format. The topic is ``market-data-yyyyMMdd`` of
    ``topic_day`` (a column; default the tick's own ``time``).
    """
    text = lambda c: utc_text(F.col(c), type_of(ticks, c))
    fields = []
    for c in TICK_COLUMNS:
        if c in NUMERIC_COLUMNS:
            fields.append(F.col(c).cast("string").alias(c))
        elif c in INTEGER_COLUMNS:
            fields.append(F.col(c))
        elif c == "time":
            fields.append(F.concat(F.replace(text(c), F.lit(" "), F.lit("T")), F.lit("Z")).alias(c))
        elif c == "recieved":
            day = F.concat(F.substring(text(c), 9, 2), F.lit("-"), F.substring(text(c), 6, 2), F.lit("-"), F.substring(text(c), 1, 4))
            fields.append(F.concat(day, F.substring(text(c), 11, 16)).alias("Recieved"))
        else:
            fields.append(F.col(c))
    day = F.date_format(topic_day, "yyyyMMdd") if topic_day is not None else F.replace(F.substring(text("time"), 1, 10), F.lit("-"), F.lit(""))
    return ticks.select(
        F.concat(F.lit(TOPIC_PREFIX), day).alias("topic"),
        F.col("product_id").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        *extra)


def publish_ticks(messages: DataFrame, bootstrap_servers: str, checkpoint: str | None = None):
    """Send ``topic, key, value`` to Kafka (batch frame or stream)."""
    if messages.isStreaming:
        return (messages.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers)
                .option("checkpointLocation", checkpoint)
                .start())
    (messages.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers).save())
    return None
