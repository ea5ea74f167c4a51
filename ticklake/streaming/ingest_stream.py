"""SS3: tick stream -> typed Parquet table + dead letters + ingest metrics.

Each micro-batch is validated once (persisted for its two writes; the metrics are
observed while the dead letters are written) and
written with the query's own id and the batch id as the innermost partition
directory, so that any number of streams can feed one table. The sinks
use dynamic partition overwrite, so when Spark replays a batch after a
failure (``foreachBatch`` is at-least-once) the same directories are
replaced instead of appended to: the table holds every message once.
Offsets and the commit log live in the checkpoint folder.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.operators.ingest import dead_letters, good_ticks, ingest, observed, observed_metrics
from ticklake.sources.sinks import append_ticks, write_dead_letters


def batch_name(batch_id: int, owner: str = "") -> str:
    """Directory name of a micro-batch; ``owner`` tells the queries that feed one table apart."""
    return f"b{batch_id:012d}" + (f"-{owner}" if owner else "")


def query_owner(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps in its checkpoint for life; a new checkpoint has another."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"].replace("-", "")


def ingest_batch(raw: DataFrame, batch_id: int, table_root: str, dead_root: str,
                 metrics_root: str | None = None, owner: str = "") -> None:
    """Process one micro-batch of ``key, value`` rows (also usable on a batch frame)."""
    name = batch_name(batch_id, owner)
    validated = ingest(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_ticks(good_ticks(validated), table_root, name)
        # observed in the job that has no shuffle: if a shuffle turns out empty, adaptive execution drops what was observed before it
        counted, seen = observed(validated)
        write_dead_letters(dead_letters(counted), dead_root, name)
        if metrics_root:
            (observed_metrics(raw.sparkSession, seen).withColumn("batch", F.lit(name))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").json(metrics_root))
    finally:
        validated.unpersist()


def start_ingest(stream: DataFrame, table_root: str, dead_root: str, checkpoint: str,
                 metrics_root: str | None = None, available_now: bool = False,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the ingest query on a ``key, value`` stream (``read_tick_stream``)."""
    owner: list[str] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        if not owner:
            owner.append(query_owner(batch.sparkSession, checkpoint))
        ingest_batch(batch, batch_id, table_root, dead_root, metrics_root, owner[0])

    writer = (stream.writeStream
              .foreachBatch(process)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
