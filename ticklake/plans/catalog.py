"""Registered queries over the driver's tables, with fixed parameters.

Ticks are derived from ``events`` (``fixture.ticks_from_events``); every
query reads the whole ``events`` table through that mapping. Double results
are rounded to six decimals for comparison, the same as in the oracle SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake import plans
from ticklake.fixture import fixture_ticks, load_events, messages_from_events, ticks_from_events
from ticklake.functions.timecols import utc_wall
from ticklake.functions.bands import correlation_band, return_direction, volatility_band
from ticklake.operators import book
from ticklake.operators import ingest as ing
from ticklake.session import cut, scratch_path
from ticklake.sources.compaction import compact_table, fragmented_partitions
from ticklake.sources.scan import scan_ticks
from ticklake.sources.sinks import append_ticks, to_messages
from ticklake.sources.stream import read_tick_stream
from ticklake.streaming import (
    add_subscriptions, remove_subscriptions, start_ingest, start_subscribed, stream_recent_quotes, stream_top_of_book)
from ticklake.streaming.book_stream import current_recent_quotes
from ticklake.streaming.runner import finish, run_to_table

# Fixed parameters of the registered queries (FIXTURES.md §4).
AS_OF = datetime(2024, 1, 15, 12, 0, 0)
DAY = "2024-01-15"
MONTH = ("2024-01-01", "2024-01-31")
#: All days of ``events`` are past on this one.
CLOSED = date(2024, 2, 1)
TWO_DAYS = ("2024-01-15", "2024-01-16")
SYMBOLS = ["click", "error", "purchase", "signup", "view"]
PAIR = ("click", "error")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (float sums depend on evaluation order)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields])


def _q(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(fixture_ticks(spark, sf_dir)))
    run.__doc__ = fn.__doc__
    return run


def analytic_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "high_low_1h": _q(lambda t: plans.high_low(t, SYMBOLS, "1h", AS_OF)),
        "high_low_day": _q(lambda t: plans.high_low(t, "click", "day", AS_OF)),
        "high_low_5m": _q(lambda t: plans.high_low(t, SYMBOLS, "5m", AS_OF)),
        "high_low_2w": _q(lambda t: plans.high_low(t, SYMBOLS, "2w", AS_OF)),
        "latest_prices": _q(lambda t: plans.latest_prices(t, SYMBOLS, 10, AS_OF)),
        "latest_prices_3": _q(lambda t: plans.latest_prices(t, SYMBOLS, 3, AS_OF)),
        "quickvwap": _q(lambda t: plans.quickvwap(t, DAY)),
        "vwap_30m": _q(lambda t: plans.vwap(t, SYMBOLS, "30m", AS_OF)),
        "vwap_15m": _q(lambda t: plans.vwap(t, SYMBOLS, "15m", AS_OF)),
        "vwap_day": _q(lambda t: plans.vwap(t, "error", "day", AS_OF)),
        "returns_day": _q(lambda t: plans.returns(t, None, DAY)),
        "returns_month": _q(lambda t: plans.returns(t, None, MONTH)),
        "volatility_day": _q(lambda t: plans.volatility(t, None, DAY)),
        "volatility_month": _q(lambda t: plans.volatility(t, None, MONTH)),
        "correlation_month": _q(lambda t: plans.correlation(t, *PAIR, MONTH)),
        "correlation_hourly": _q(lambda t: plans.correlation(t, *PAIR, MONTH, unit="hour")),
        "dataset": _q(lambda t: plans.dataset(t, DAY)),
        "dataset_month": _q(lambda t: plans.dataset(t, MONTH)),
        "vwap_on_date": _q(lambda t: plans.vwap_on_date(t, "click", DAY)),
        "symbols_on_date": _q(lambda t: plans.symbols_on_date(t, DAY)),
        "day_extract": _q(lambda t: plans.day_extract(t, DAY)),
        "resample_mean": _q(lambda t: plans.resample_mean(t, DAY)),
        "resample_mean_dense": _q(lambda t: plans.resample_mean(t, DAY, dense=True)),
        "volatility_levels": _q(lambda t: plans.volatility_levels(t, DAY)),
        "volatility_events": _q(lambda t: plans.volatility_events(t, DAY)),
        "volatility_crosstab": _q(lambda t: plans.volatility_crosstab(t, DAY)),
        "sequence_gaps": _q(lambda t: plans.sequence_gaps(t, DAY)),
        "sequence_gaps_chunked": _q(lambda t: plans.sequence_gaps(t, DAY, chunk_width=64)),
        "resample_mean_dense_days": _q(lambda t: plans.resample_mean(t, TWO_DAYS, dense=True)),
        "mean_gap": _q(lambda t: plans.mean_gap(t, DAY)),
        "gap_series": _q(lambda t: plans.gap_series(t, DAY)),
        "describe_ticks": _q(lambda t: plans.describe_ticks(t, DAY)),
        "return_direction": _q(lambda t: plans.returns(t, None, MONTH)
                               .withColumn("direction", return_direction("return"))),
        "volatility_band": _q(lambda t: plans.volatility(t, None, MONTH)
                              .withColumn("band", volatility_band("volatility"))),
        "correlation_band": _q(lambda t: plans.correlation(t, *PAIR, MONTH, unit="hour")
                               .withColumn("band", correlation_band("correlation"))),
    }


# Subscription config used by the ING14/ING15 queries (symbols not in the
# data on purpose, so both branches of the diff are exercised).
WANTED = ["click", "view", "BTC-USD", "SPY"]


def _ntz(df: DataFrame) -> DataFrame:
    """``timestamp`` columns as the ``timestamp_ntz`` of UTC, for the oracle."""
    return df.select(*[
        utc_wall(F.col(f.name), f.dataType).alias(f.name)
        for f in df.schema.fields])


def _events_q(fn: Callable[[SparkSession, DataFrame], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(_ntz(fn(spark, load_events(spark, sf_dir))))
    return run


def book_and_ingest_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def validated(events):
        return ing.ingest(messages_from_events(events))

    return {
        "top_of_book": _q(book.top_of_book),
        "recent_quotes": _q(book.recent_quotes),
        "ingest_typed": _events_q(lambda s, e: ing.good_ticks(validated(e))),
        "dead_letter_counts": _events_q(
            lambda s, e: ing.dead_letters(validated(e)).groupBy("key", "reason")
            .agg(F.count(F.lit(1)).alias("n"))),
        "ingest_metrics": _events_q(lambda s, e: ing.ingest_metrics(validated(e))),
        "publish_messages": _events_q(lambda s, e: to_messages(ticks_from_events(e))),
        "normalize_side": _q(lambda t: ing.normalize_side(t).groupBy("product_id", "side")
                             .agg(F.count(F.lit(1)).alias("n"))),
        "filter_subscribed": _events_q(
            lambda s, e: ing.filter_subscribed(ticks_from_events(e), ing.subscriptions_frame(s, WANTED))
            .groupBy("product_id").agg(F.count(F.lit(1)).alias("row_count"))),
        "subscription_diff": _events_q(
            lambda s, e: ing.subscription_diff(
                ing.subscriptions_frame(s, WANTED),
                plans.symbols_on_date(ticks_from_events(e), DAY))),
    }


#: Parts that the registered streams read, and how many of them make a micro-batch.
FILES, FILES_A_BATCH = 8, 2
#: Rows of a file of such a part, about: a part of more is several files, as one is read by one task.
ROWS_A_FILE = 50_000


def _event_stream(spark: SparkSession, sf_dir: str, by_days: bool = False) -> DataFrame:
    """``events`` of ``sf_dir`` as a stream of ``FILES`` parts, about ``FILES_A_BATCH`` of them a micro-batch: each of some days, or all over the month.

    All parts are as many files, by the number of events; rows without a part are one more.
    """
    events = load_events(spark, sf_dir)
    path = scratch_path(spark, "event-files")
    files = max(1, -(-events.count() // (FILES * ROWS_A_FILE)))
    part = F.floor((F.dayofmonth("ts") - 1) * F.lit(FILES) / 31) if by_days else F.pmod("event_id", F.lit(FILES))
    # the number of a file is its task's, so that no two share one and none is split
    number = F.coalesce(part, F.lit(FILES)) * files + F.pmod(F.xxhash64(*events.columns), F.lit(files))
    (events.withColumn("part", part).repartitionById((FILES + 1) * files, number.cast("int"))
     .write.option("maxRecordsPerFile", 0).partitionBy("part").parquet(path))
    return (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES_A_BATCH * files)
            .option("recursiveFileLookup", "true").parquet(path))


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def tob(spark: SparkSession, sf_dir: str) -> DataFrame:
        ticks = ticks_from_events(_event_stream(spark, sf_dir))
        path = run_to_table(spark, stream_top_of_book(ticks), "stream-top-of-book", "complete")
        return round_doubles(spark.read.parquet(path))

    def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
        ticks = ticks_from_events(_event_stream(spark, sf_dir))
        path = run_to_table(spark, stream_recent_quotes(ticks), "stream-recent-quotes", "append")
        emitted = spark.read.parquet(path).drop("batch")
        return round_doubles(_ntz(current_recent_quotes(emitted)))

    def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_path(spark, "stream-ingest")
        msgs = messages_from_events(_event_stream(spark, sf_dir, by_days=True))
        q = start_ingest(msgs, f"{base}/table", f"{base}/dead", f"{base}/_checkpoint",
                         f"{base}/metrics", available_now=True)
        finish(q)
        return round_doubles(_ntz(scan_ticks(spark, f"{base}/table")))

    def ingest_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
        """SNK2 and ING10 of the same stream, read back: dead letters by key and reason, and the metrics of all micro-batches."""
        base = scratch_path(spark, "stream-outputs")
        q = start_ingest(messages_from_events(_event_stream(spark, sf_dir, by_days=True)), f"{base}/table", f"{base}/dead", f"{base}/_checkpoint",
                         f"{base}/metrics", available_now=True)
        finish(q)
        dead = spark.read.schema("key string, reason string, value string, batch string").json(f"{base}/dead")
        metrics = spark.read.schema("processed long, errors long, dropped long, error_pct double, batch string").json(f"{base}/metrics")
        sums = metrics.agg(*[F.sum(c).alias(c) for c in ("processed", "errors", "dropped")], F.count("*").alias("batches"))
        counts = F.array(*[F.struct(F.lit("metrics").alias("key"), F.lit(c).alias("reason"), F.col(c).alias("n")) for c in ("processed", "errors", "dropped", "batches")])
        return dead.groupBy("key", "reason").agg(F.count("*").alias("n")).unionByName(sums.select(F.inline(counts)))

    def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
        """SRC3 and ING11: messages from files of JSON lines, admitted some files at a time; of each file, its rows and the files of its micro-batch."""
        src = scratch_path(spark, "message-files")
        events = load_events(spark, sf_dir).withColumn("_part", F.pmod("event_id", F.lit(FILES)))
        for k in range(FILES):  # one file each, named by its place
            messages_from_events(events.where(F.col("_part") == k), corrupt=False).select("value").coalesce(1).write.mode("append").text(f"{src}/part={k}")
        stream = read_tick_stream(spark, path=src, max_per_trigger=FILES_A_BATCH)
        path = run_to_table(spark, stream, "stream-batches", "append")
        part = F.pmod(F.get_json_object("value", "$.sequence").cast("long"), F.lit(FILES))
        rows = spark.read.parquet(path).groupBy("batch", part.alias("part")).agg(F.count("*").alias("n"), F.countDistinct("key").alias("symbols"))
        of = rows.groupBy("batch").agg(F.count("*").alias("files_in_batch"))
        return rows.join(of, "batch").select("part", "n", "symbols", "files_in_batch")

    def subscribed(spark: SparkSession, sf_dir: str) -> DataFrame:
        """ING14 on a stream: the first half of the ticks under one set of symbols, the second half under an edited one."""
        base = scratch_path(spark, "stream-subscribed")
        events, subs = load_events(spark, sf_dir), f"{base}/subscriptions"
        add_subscriptions(spark, subs, WANTED)
        for half in (0, 1):
            events.where(F.pmod("event_id", F.lit(2)) == half).coalesce(1).write.mode("append").parquet(f"{base}/in")
            ticks = ticks_from_events(spark.readStream.schema(events.schema).parquet(f"{base}/in"))
            finish(start_subscribed(ticks, subs, f"{base}/out", f"{base}/_checkpoint", available_now=True))
            if not half:
                add_subscriptions(spark, subs, ["error", "click"])
                remove_subscriptions(spark, subs, ["view"])
        out = spark.read.parquet(f"{base}/out")
        return out.groupBy("product_id", F.pmod("sequence", F.lit(2)).alias("half")).agg(F.count("*").alias("n"))

    return {"stream_top_of_book": tob, "stream_recent_quotes": recent, "stream_ingest": ingest_stream,
            "stream_ingest_outputs": ingest_outputs, "stream_batches": batches, "stream_subscribed": subscribed}


def _stored(spark: SparkSession, sf_dir: str, batches: int = 2) -> str:
    """A tick table of the whole ``events``, appended in ``batches`` named writes."""
    root = scratch_path(spark, "stored-ticks")
    ticks = fixture_ticks(spark, sf_dir)
    for b in range(batches):
        append_ticks(ticks.where(F.pmod("sequence", F.lit(batches)) == b), root, f"b{b}")
    return root


def stored_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries over a table on disk (SRC1 by day, SRC2, SNK1), and its compaction (SNK4, SNK5)."""

    def over(days, fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(_ntz(fn(scan_ticks(spark, _stored(spark, sf_dir, 1), days))))
        return run

    def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All rows, after every closed day was compacted and one of the merged batches was written again."""
        root = _stored(spark, sf_dir)
        compact_table(spark, root, today=CLOSED)
        append_ticks(fixture_ticks(spark, sf_dir).where(F.pmod("sequence", F.lit(2)) == 1), root, "b1")
        return round_doubles(_ntz(scan_ticks(spark, root)))

    def fragmented(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Files of the symbol-days that need packing, before compaction and after it (none)."""
        root = _stored(spark, sf_dir)
        cols = [F.col(c) for c in ("year", "month", "day", "product_id", "files")]
        before = cut(fragmented_partitions(spark, root).select(F.lit("before").alias("state"), *cols))
        compact_table(spark, root, today=CLOSED)
        return before.unionByName(fragmented_partitions(spark, root).select(F.lit("after").alias("state"), *cols))

    def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
        """ING2, ING3 and ING12: facts of the clocks' columns, as clocks themselves vary."""
        events = load_events(spark, sf_dir)
        t = ing.only_tickers(ticks_from_events(events)).withColumn("_before", F.current_timestamp())
        t = ing.route_topic(ing.stamp_consumed_stored(ing.stamp_received(t, "received_at")), F.col("time"))
        stamp = ing.parse_received(F.col("received_at"))
        fine = stamp.isNotNull() & (F.col("Consumed") <= F.col("Stored")) & (F.col("Consumed") >= F.col("_before"))
        return t.groupBy("topic", "key").agg(F.count("*").alias("n"), F.count_if(fine).alias("stamped"))

    return {
        "stored_high_low": over(DAY, lambda t: plans.high_low(t, SYMBOLS, "1h", AS_OF)),
        "stored_quickvwap": over(DAY, lambda t: plans.quickvwap(t, DAY)),
        "stored_returns": over(MONTH, lambda t: plans.returns(t, None, MONTH)),
        "stored_resample_mean": over(DAY, lambda t: plans.resample_mean(t, DAY)),
        "stored_sequence_gaps": over(DAY, lambda t: plans.sequence_gaps(t, DAY)),
        "compact_table_rows": compacted,
        "fragmented_partitions": fragmented,
        "ingest_stamps": stamps,
    }


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(analytic_queries())
    out.update(book_and_ingest_queries())
    out.update(stream_queries())
    out.update(stored_queries())
    return out
