"""SS1-SS3 over files of JSON lines, compared with the batch forms."""

import os

from pyspark.sql import functions as F

from ticklake.fixture import load_events, messages_from_events
from ticklake.operators import book
from ticklake.operators.ingest import dead_letters, good_ticks, ingest
from ticklake.sources.scan import scan_ticks
from ticklake.sources.stream import read_tick_stream
from ticklake.streaming import start_ingest, stream_recent_quotes, stream_top_of_book
from ticklake.streaming.book_stream import current_recent_quotes
from ticklake.streaming.ingest_stream import ingest_batch
from tests.conftest import SF_SMALL

COLS = ["sequence", "product_id", "price", "last_size", "time", "recieved", "year", "month", "day"]


def _write_messages(spark, path, n_files=4):
    msgs = messages_from_events(load_events(spark, SF_SMALL).where("day(ts) in (3, 4, 15)"))
    msgs.select("value").repartition(n_files).write.text(path)
    return msgs


def _multiset(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_stream_ingest_matches_batch_and_restart_adds_nothing(spark, workdir):
    src = os.path.join(workdir, "in")
    msgs = _write_messages(spark, src)
    table, dead, ckpt, met = (os.path.join(workdir, x) for x in ("table", "dead", "ckpt", "metrics"))
    stream = read_tick_stream(spark, path=src, max_per_trigger=1)
    q = start_ingest(stream, table, dead, ckpt, met, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None

    raw = msgs.select(F.get_json_object("value", "$.product_id").alias("key"), "value")
    expected = good_ticks(ingest(raw))
    got = scan_ticks(spark, table)
    assert "batch" not in got.columns
    assert _multiset(got) == _multiset(expected)

    dl = spark.read.json(dead)
    exp_dl = dead_letters(ingest(raw))
    assert (sorted(tuple(r) for r in dl.groupBy("reason").count().collect())
            == sorted(tuple(r) for r in exp_dl.groupBy("reason").count().collect()))
    # ING11: one file per trigger -> several micro-batches, each with its own metrics row
    assert spark.read.json(met).select("batch").distinct().count() >= 2
    m = spark.read.json(met).agg(F.sum("processed"), F.sum("errors")).first()
    assert m[0] == msgs.count() and m[1] == exp_dl.count()

    # restart from the same checkpoint: nothing new
    n = got.count()
    q2 = start_ingest(read_tick_stream(spark, path=src), table, dead, ckpt, met, available_now=True)
    q2.awaitTermination(300)
    assert scan_ticks(spark, table).count() == n


def test_event_stream_has_more_files_for_more_events_in_as_many_batches(spark, workdir, monkeypatch):
    from ticklake.plans import catalog

    monkeypatch.setattr(catalog, "ROWS_A_FILE", 50, raising=False)
    n = F.col("id")
    events = spark.range(3100).select(
        n.alias("event_id"), F.make_timestamp_ntz(F.lit(2024), F.lit(1), (n % 31 + 1).cast("int"), F.lit(1), F.lit(2), F.lit(3)).alias("ts"),
        (n % 7).alias("user_id"), F.lit("click").alias("event_type"), n.cast("double").alias("value"), F.lit(None).cast("string").alias("props"))
    events.write.parquet(f"{workdir}/events.parquet")
    for by_days in (False, True):
        ids, tasks = [], []

        def keep(batch, _bid):
            rows = batch.select("event_id", F.spark_partition_id()).collect()
            ids.extend(r[0] for r in rows)
            tasks.append(len({r[1] for r in rows}))

        q = (catalog._event_stream(spark, workdir, by_days).writeStream.foreachBatch(keep).trigger(availableNow=True)
             .option("checkpointLocation", f"{workdir}/c-{by_days}").start())
        q.awaitTermination(300)
        assert q.exception() is None and sorted(ids) == list(range(3100))
        assert len(tasks) == 4 and min(tasks) > 2  # a micro-batch was two tasks, however many events it held


def test_replayed_batch_is_idempotent(spark, workdir):
    table, dead = os.path.join(workdir, "t"), os.path.join(workdir, "d")
    raw = messages_from_events(load_events(spark, SF_SMALL).where("day(ts) in (3, 4, 15)"))
    ingest_batch(raw, 7, table, dead)
    n = scan_ticks(spark, table).count()
    ingest_batch(raw, 7, table, dead)  # same batch id again (at-least-once replay)
    assert scan_ticks(spark, table).count() == n
    ingest_batch(raw.limit(10), 8, table, dead)
    assert scan_ticks(spark, table).count() > n


def test_metrics_of_a_batch_without_good_ticks(spark, workdir):
    undated = '{"type": "ticker", "product_id": "SPY", "price": "1"}'
    rows = {0: ["{", undated, '{"type": "subscriptions"}'], 1: ['{"type": "subscriptions"}'], 2: []}
    for batch, values in rows.items():
        raw = spark.createDataFrame([("SPY", v) for v in values], "key string, value string")
        ingest_batch(raw, batch, f"{workdir}/t", f"{workdir}/d", f"{workdir}/m")
    seen = spark.read.schema("processed long, errors long, dropped long, batch string").json(f"{workdir}/m").orderBy("batch").collect()
    assert [tuple(r)[:3] for r in seen] == [(3, 2, 1), (1, 0, 1), (0, 0, 0)]
    assert sorted(r["reason"] for r in spark.read.json(f"{workdir}/d").collect()) == ["bad_json", "no_date"]


def test_stream_book_matches_batch(spark, workdir):
    src = os.path.join(workdir, "in")
    msgs = _write_messages(spark, src, 3)
    raw = msgs.select(F.get_json_object("value", "$.product_id").alias("key"), "value")
    batch_ticks = good_ticks(ingest(raw))

    ticks_stream = good_ticks(ingest(read_tick_stream(spark, path=src, max_per_trigger=1)))
    q1 = (stream_top_of_book(ticks_stream).writeStream.outputMode("complete").format("memory")
          .queryName("tob_test").trigger(availableNow=True)
          .option("checkpointLocation", os.path.join(workdir, "c1")).start())
    q1.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("tob_test").collect())
    exp = sorted(tuple(r) for r in book.top_of_book(batch_ticks).collect())
    assert got == exp

    exp = sorted(tuple(r) for r in book.recent_quotes(batch_ticks).collect())
    for salts in (1, 5):
        q2 = (stream_recent_quotes(ticks_stream, salts=salts).writeStream.outputMode("append").format("memory")
              .queryName(f"recent_{salts}").trigger(availableNow=True)
              .option("checkpointLocation", os.path.join(workdir, f"c2-{salts}")).start())
        q2.awaitTermination(300)
        out = spark.table(f"recent_{salts}")
        # a symbol's state is spread over the salts, and each share is updated by several micro-batches
        assert out.groupBy("product_id").agg(F.countDistinct("salt").alias("n")).agg(F.min("n")).first()[0] >= min(salts, 3)
        assert out.agg(F.max("version")).first()[0] >= 3
        assert sorted(tuple(r) for r in current_recent_quotes(out).collect()) == exp


def test_latest_quotes_of_a_share():
    import pandas as pd

    from ticklake.streaming.book_stream import _latest, _plain

    frame = pd.DataFrame({"bid": [1.0, 2.0, 3.0, None], "bid_size": 1.0, "ask": 1.0, "ask_size": 1.0, "micros": [5, 9, 9, 7], "sequence": pd.Series([1, None, 4, 2], dtype="Int64")})
    assert _latest([_plain(frame, 2)], 2)["bid"] == [3.0, 2.0]
    top = _latest([_plain(frame.iloc[:2], 3), _plain(frame.iloc[2:], 3)], 3)
    assert (top["bid"], top["sequence"]) == ([3.0, 2.0, None], [4, None, 2])


def test_subscription_edits(spark, workdir):
    import pytest

    from ticklake.streaming import add_subscriptions, remove_subscriptions, subscriptions

    now = lambda: sorted(r["product_id"] for r in subscriptions(spark, f"{workdir}/s").collect())
    assert now() == []
    add_subscriptions(spark, f"{workdir}/s", ["SPY", "QQQ", "SPY"])
    add_subscriptions(spark, f"{workdir}/s", ["QQQ", "BTC-USD"])
    assert now() == ["BTC-USD", "QQQ", "SPY"]
    remove_subscriptions(spark, f"{workdir}/s", ["SPY"])
    assert now() == ["BTC-USD", "QQQ"]
    with pytest.raises(ValueError, match="IWM"):
        remove_subscriptions(spark, f"{workdir}/s", ["QQQ", "IWM"])
    with pytest.raises(ValueError):
        add_subscriptions(spark, f"{workdir}/s", ["A;B"])
    assert now() == ["BTC-USD", "QQQ"]


def test_observed_metrics_equal_a_second_pass(spark):
    from ticklake.operators.ingest import ingest_metrics, observed, observed_metrics

    validated = ingest(messages_from_events(load_events(spark, SF_SMALL)))
    counted, seen = observed(validated)
    good_ticks(counted).write.format("noop").mode("overwrite").save()
    assert observed_metrics(spark, seen).collect() == ingest_metrics(validated).collect()
    empty, seen = observed(validated.limit(0))
    good_ticks(empty).write.format("noop").mode("overwrite").save()
    assert tuple(observed_metrics(spark, seen).first()) == (0, 0, 0, 0.0)


def test_top_of_book_update_mode(spark, workdir):
    src = os.path.join(workdir, "in")
    msgs = _write_messages(spark, src, 3)
    raw = msgs.select(F.get_json_object("value", "$.product_id").alias("key"), "value")
    exp = {r["product_id"]: tuple(r) for r in book.top_of_book(good_ticks(ingest(raw))).collect()}
    seen = {}

    def keep(batch, _bid):
        for r in batch.collect():  # test sink: a handful of rows per batch
            seen[r["product_id"]] = tuple(r)

    ticks = good_ticks(ingest(read_tick_stream(spark, path=src, max_per_trigger=1)))
    q = (stream_top_of_book(ticks).writeStream.outputMode("update").foreachBatch(keep)
         .trigger(availableNow=True).option("checkpointLocation", os.path.join(workdir, "c")).start())
    q.awaitTermination(300)
    assert seen == exp
