"""SRC3: the tick stream, from Kafka or from files of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schema import TOPIC_PREFIX


def read_tick_stream(spark: SparkSession, *, bootstrap_servers: str | None = None,
                     path: str | None = None, max_per_trigger: int | None = None,
                     starting_offsets: str = "earliest") -> DataFrame:
    """Streaming frame of ``key, value`` (text).

    Kafka: every daily ``market-data-*`` topic, from the earliest offset on a
    first start (then from the checkpoint). Files: one JSON message per line;
    the key is the message's ``product_id`` as the producer keys by symbol.
    ``max_per_trigger`` bounds a micro-batch (offsets or files).
    """
    if bootstrap_servers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("subscribePattern", TOPIC_PREFIX + ".*")
                  .option("startingOffsets", starting_offsets))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(F.col("key").cast("string").alias("key"),
                                    F.col("value").cast("string").alias("value"))
    if not path:
        raise ValueError("give bootstrap_servers or path")
    reader = spark.readStream.format("text")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    lines = reader.load(path)
    return lines.select(F.get_json_object("value", "$.product_id").alias("key"), F.col("value"))
