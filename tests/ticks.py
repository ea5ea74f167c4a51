"""Build small tick frames from hand-made rows (missing fields are NULL)."""

from datetime import datetime

from pyspark.sql import functions as F

from ticklake.schema import TICK_SCHEMA


def make_ticks(spark, rows):
    full = []
    for i, r in enumerate(rows):
        d = {f.name: None for f in TICK_SCHEMA.fields}
        d.update({"type": "ticker", "sequence": i + 1, "trade_id": i + 1, "last_size": 1.0})
        d.update(r)
        if isinstance(d["time"], str):
            d["time"] = datetime.fromisoformat(d["time"])
        if d.get("best_bid") is None and d.get("price") is not None:
            d["best_bid"], d["best_ask"] = d["price"] - 0.01, d["price"] + 0.01
            d["best_bid_size"], d["best_ask_size"] = 1.0, 2.0
        full.append(tuple(d[f.name] for f in TICK_SCHEMA.fields))
    df = spark.createDataFrame(full, TICK_SCHEMA)
    return (df.withColumn("year", F.year("time")).withColumn("month", F.month("time"))
              .withColumn("day", F.dayofmonth("time")))
