"""Tick files in the older layout (bare symbol directories, nanosecond time)."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ticklake import plans
from ticklake.fixture import fixture_ticks
from ticklake.schema import NUMERIC_COLUMNS
from ticklake.sources.scan import scan_foreign_ticks
from tests.conftest import SF_SMALL

DAY = "2024-01-15"


def _write_foreign(spark, root):
    ticks = fixture_ticks(spark, SF_SMALL).where("day IN (14, 15)")
    pdf = ticks.withColumn("time", F.col("time").cast("timestamp")).toPandas()
    schema = pa.schema(
        [("type", pa.string()), ("sequence", pa.int64()), ("product_id", pa.string())]
        + [(c, pa.float64()) for c in NUMERIC_COLUMNS]
        + [("side", pa.string()), ("time", pa.timestamp("ns", tz="UTC")), ("trade_id", pa.int64()),
           ("Recieved", pa.timestamp("us"))])
    for (day, sym), part in pdf.groupby(["day", "product_id"]):
        d = os.path.join(root, "year=2024", "month=01", f"day={day:02d}", sym)
        os.makedirs(d, exist_ok=True)
        body = part.rename(columns={"recieved": "Recieved"})[schema.names].copy()
        body["time"] = body["time"].dt.tz_localize("UTC")
        for i, half in enumerate((body.iloc[::2], body.iloc[1::2])):
            pq.write_table(pa.Table.from_pandas(half, schema=schema, preserve_index=False),
                           os.path.join(d, f"{i}-part.snappy.parquet"))
    return ticks


def test_foreign_layout_reads_like_native(spark, workdir):
    native = _write_foreign(spark, workdir)
    foreign = scan_foreign_ticks(spark, workdir)
    assert foreign.count() == native.count()
    a = sorted(tuple(r) for r in plans.quickvwap(foreign, DAY).collect())
    b = sorted(tuple(r) for r in plans.quickvwap(native, DAY).collect())
    assert a == b
    ra = sorted(tuple(r) for r in plans.returns(foreign, None, DAY).select("product_id", "price", "return").collect())
    rb = sorted(tuple(r) for r in plans.returns(native, None, DAY).select("product_id", "price", "return").collect())
    assert ra == rb
    plan = plans.dataset(foreign, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan
