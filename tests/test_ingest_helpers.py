"""ING2, ING3, ING12, ING13, ING15 and the message encoding (SNK3)."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from ticklake.functions import correlation_band, return_direction, volatility_band
from ticklake.operators import ingest as ing
from ticklake.sources.sinks import to_messages
from tests.ticks import make_ticks


def test_stamp_route_and_clocks(spark):
    df = spark.createDataFrame([("A", datetime(2024, 1, 15, 10))], "product_id string, time timestamp")
    out = ing.route_topic(ing.stamp_received(df), F.col("time")).first()
    assert out["topic"] == "market-data-20240115" and out["key"] == "A"
    datetime.strptime(out["Recieved"], "%d-%m-%Y %H:%M:%S.%f")
    assert {"Consumed", "Stored"} <= set(ing.stamp_consumed_stored(df).columns)


def test_messages_round_trip(spark):
    t = make_ticks(spark, [{"product_id": "A", "price": 106.55, "time": "2024-01-15 10:00:00.5",
                            "recieved": datetime(2024, 1, 15, 10, 0, 1), "side": "buy"}])
    m = to_messages(t).first()
    assert m["topic"] == "market-data-20240115" and m["key"] == "A"
    body = json.loads(m["value"])
    assert body["price"] == "106.55" and body["sequence"] == 1
    assert body["Recieved"] == "15-01-2024 10:00:01.000000"
    back = ing.good_ticks(ing.ingest(to_messages(t).select("key", "value"))).first()
    assert back["price"] == 106.55 and back["time"] == datetime(2024, 1, 15, 10, 0, 0, 500000)


def test_normalize_side_and_diff(spark):
    df = spark.createDataFrame([("SELL_SHORT",), ("Buy",), ("sell",), ("x",)], "side string")
    assert [r[0] for r in ing.normalize_side(df).collect()] == ["sell", "buy", "sell", None]
    w = ing.subscriptions_frame(spark, ["A", "B"])
    a = ing.subscriptions_frame(spark, ["B", "C"])
    got = sorted(tuple(r) for r in ing.subscription_diff(w, a).collect())
    assert got == [("A", "add"), ("C", "remove")]


def test_bands(spark):
    df = spark.createDataFrame([(0.0001,), (0.001,), (0.005,), (0.015,), (0.05,), (0.2,)], "v double")
    got = [r[0] for r in df.select(volatility_band("v")).collect()]
    assert got == [None, "quiet", "typical", "active", "highly volatile", "extreme"]
    df = spark.createDataFrame([(1.0,), (0.7,), (0.0,), (0.2,), (-0.7,), (-1.0,)], "c double")
    got = [r[0] for r in df.select(correlation_band("c")).collect()]
    assert got == ["perfectly together", "typically together", "none", "weak",
                   "typically opposite", "perfect opposites"]
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.0,)], "r double")
    assert [r[0] for r in df.select(return_direction("r")).collect()] == ["up", "down", "flat"]


# The reference's test subscription list and its default configuration.
TEST_TICKERS = ["BTC-USD", "SPY", "SOL-USD", "QQQ", "IWM"]
DEFAULT_TICKERS = ["SOL-USD", "BTC-USD", "XRP-USD", "USDT-USD", "DOGE-USD", "ETH-USD", "AERO-USD"]


def test_subscriptions_like_the_reference(spark):
    wanted = ing.subscriptions_frame(spark, TEST_TICKERS)
    assert sorted(r[0] for r in wanted.collect()) == sorted(TEST_TICKERS)
    active = ing.subscriptions_frame(spark, DEFAULT_TICKERS)
    diff = {(r["product_id"], r["action"]) for r in ing.subscription_diff(wanted, active).collect()}
    assert diff == ({(s, "add") for s in ("SPY", "QQQ", "IWM")}
                    | {(s, "remove") for s in ("XRP-USD", "USDT-USD", "DOGE-USD", "ETH-USD", "AERO-USD")})
    t = make_ticks(spark, [{"product_id": s, "price": 1.0, "time": "2024-01-15 10:00:00"}
                           for s in TEST_TICKERS + ["ETH-USD"]])
    kept = {r[0] for r in ing.filter_subscribed(t, DEFAULT_TICKERS).select("product_id").collect()}
    assert kept == {"BTC-USD", "SOL-USD", "ETH-USD"}
    kept_df = {r[0] for r in ing.filter_subscribed(t, wanted).select("product_id").collect()}
    assert kept_df == set(TEST_TICKERS)


def test_filter_subscribed_on_a_stream(spark, workdir):
    import os

    from ticklake.fixture import load_events, messages_from_events
    from ticklake.sources.stream import read_tick_stream
    from tests.conftest import SF_SMALL

    src = os.path.join(workdir, "in")
    messages_from_events(load_events(spark, SF_SMALL), corrupt=False).select("value").write.text(src)
    subs = ing.subscriptions_frame(spark, ["click", "view"])
    stream = ing.filter_subscribed(ing.good_ticks(ing.ingest(read_tick_stream(spark, path=src))), subs)
    q = (stream.groupBy("product_id").count().writeStream.outputMode("complete").format("memory")
         .queryName("subs_test").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(workdir, "c")).start())
    q.awaitTermination(300)
    got = {r["product_id"] for r in spark.table("subs_test").collect()}
    assert got == {"click", "view"}


def test_binary_key_value_like_kafka(spark):
    from pyspark.sql import types as T

    msg = ('{"type":"ticker","sequence":3,"product_id":"A","price":"2.5","time":"2024-01-15T10:00:00Z",'
           '"trade_id":3,"Recieved":"15-01-2024 10:00:00.000001"}').encode()
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])
    raw = spark.createDataFrame([(b"A", bytearray(msg)), (None, bytearray(msg))], schema)
    v = ing.ingest(raw)
    assert sorted(r["key"] for r in v.collect()) == ["", "A"]
    good = ing.good_ticks(v).collect()
    assert len(good) == 2 and all(r["price"] == 2.5 and r["sequence"] == 3 for r in good)
