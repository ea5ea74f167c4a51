"""ING14 on a stream: ticks of subscribed symbols, by the set that holds when a micro-batch begins.

The set is a small table of versions (``version=N/`` under a folder); an edit writes the next version whole, so a reader sees
one or the other. A static side of a stream join is listed once when the query starts, so it would not see an edit; here
each micro-batch reads the newest version.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.functions.params import validate_symbol
from ticklake.operators.ingest import filter_subscribed, subscriptions_frame
from ticklake.sources.layout import file_system

_SCHEMA = "product_id string"


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that were written to their end."""
    fs, p, path_class = file_system(spark, root)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version=") and fs.exists(path_class(f"{root}/{n}/_SUCCESS")))


def subscriptions(spark: SparkSession, root: str) -> DataFrame:
    """``product_id`` of the newest version; empty before the first."""
    versions = _versions(spark, root)
    return spark.read.schema(_SCHEMA).parquet(f"{root}/version={versions[-1]}") if versions else spark.createDataFrame([], _SCHEMA)


def _write(wanted: DataFrame, root: str) -> int:
    spark = wanted.sparkSession
    n = ([0] + _versions(spark, root))[-1] + 1
    wanted.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/version={n}")
    return n


def add_subscriptions(spark: SparkSession, root: str, symbols: Iterable[str]) -> int:
    """The next version, with ``symbols`` added; one that is there already is not doubled."""
    new = subscriptions_frame(spark, [validate_symbol(s) for s in symbols])
    return _write(subscriptions(spark, root).unionByName(new).distinct(), root)


def remove_subscriptions(spark: SparkSession, root: str, symbols: Iterable[str]) -> int:
    """The next version, without ``symbols``; ``ValueError`` if one of them is not subscribed."""
    wanted = sorted({validate_symbol(s) for s in symbols})
    gone, now = subscriptions_frame(spark, wanted), subscriptions(spark, root)
    unknown = [r["product_id"] for r in gone.join(now, "product_id", "left_anti").orderBy("product_id").collect()]
    if unknown:
        raise ValueError(f"NOT SUBSCRIBED {', '.join(unknown)}")
    return _write(now.join(gone, "product_id", "left_anti"), root)


def start_subscribed(ticks: DataFrame, subscriptions_root: str, out: str, checkpoint: str, available_now: bool = False,
                     processing_time: str | None = None) -> StreamingQuery:
    """Write the subscribed ticks of a stream as Parquet under ``out/batch=``; a replayed batch replaces its own files."""

    def process(batch: DataFrame, batch_id: int) -> None:
        kept = filter_subscribed(batch, subscriptions(batch.sparkSession, subscriptions_root))
        (kept.withColumn("batch", F.lit(f"b{batch_id:012d}")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(out))

    writer = ticks.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
