"""Run a streaming frame to completion into a Parquet table (``availableNow``).

Used where a stream's result is needed as a table (registered queries,
tests). Output and checkpoint live under the shared checkpoint root. Each
micro-batch is written with dynamic overwrite of its own ``batch=``
directory (append mode), or replaces the table (complete mode), so a
replayed batch does not duplicate rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.session import scratch_path


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "append",
                 timeout_s: int | None = None) -> str:
    """Runs ``stream`` to its end; raises if it does not get there in ``timeout_s`` (default: no limit)."""
    base = scratch_path(spark, name)
    out, ckpt = os.path.join(base, "data"), os.path.join(base, "_checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            batch.write.mode("overwrite").parquet(out)
        else:
            (batch.withColumn("batch", F.lit(f"b{batch_id:012d}"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").parquet(out))

    q = (stream.writeStream.outputMode(output_mode).foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    finish(q, timeout_s)
    return out


def finish(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Waits for the end of a query; a failure or a missed limit raises, so that no partial result is read."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream not finished after {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
