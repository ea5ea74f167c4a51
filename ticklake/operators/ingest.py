"""ING1-ING15: feed messages -> typed tick rows, dead letters and metrics.

All transforms are ``DataFrame -> DataFrame`` and work the same on a batch
frame and on a stream (they are used inside ``foreachBatch`` by SS3).
Every field is read as text and cast afterwards, so a bad number becomes
NULL (row kept) while a bad time, receive stamp or integer sends the row
to the dead letters with a reason.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.side import normalize_side as _normalize_side
from ticklake.functions.timecols import type_of, utc_date
from ticklake.schema import (
    INTEGER_COLUMNS, MESSAGE_FIELDS, MESSAGE_SCHEMA, NUMERIC_COLUMNS, RECEIVED_FORMAT,
    TICK_COLUMNS, TICKER_TYPE, TOPIC_PREFIX,
)

# Dead-letter reasons, in the order they are checked.
BAD_JSON, BAD_TIME, BAD_RECEIVED, BAD_INTEGER, NO_DATE = (
    "bad_json", "bad_time", "bad_received", "bad_integer", "no_date")
REASONS = [BAD_JSON, BAD_TIME, BAD_RECEIVED, BAD_INTEGER, NO_DATE]

_CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])


# ING1
def only_tickers(df: DataFrame) -> DataFrame:
    """Keep ``type == 'ticker'``."""
    return df.where(F.col("type") == TICKER_TYPE)


# ING2
def stamp_received(df: DataFrame, name: str = "Recieved") -> DataFrame:
    """Add the wall-clock receive stamp as text (``dd-MM-yyyy HH:mm:ss.SSSSSS``)."""
    return df.withColumn(name, F.date_format(F.current_timestamp(), RECEIVED_FORMAT))


# ING3
def route_topic(df: DataFrame, day_col: Column | None = None) -> DataFrame:
    """Add ``topic`` = ``market-data-yyyyMMdd`` (of ``day_col``, default now) and ``key``."""
    day = day_col if day_col is not None else F.current_timestamp()
    return (df.withColumn("topic", F.concat(F.lit(TOPIC_PREFIX), F.date_format(day, "yyyyMMdd")))
              .withColumn("key", F.col("product_id")))


# ING4 + ING5
def decode_messages(raw: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Binary or text ``key``/``value`` -> one text column per message field.

    A NULL key becomes ``''``. Absent fields are NULL, unknown fields are
    dropped by the fixed schema. ``_bad_json`` marks values that do not
    parse as a JSON object.
    """
    text = F.col(value).cast("string")
    parsed = F.from_json(text, _PARSE_SCHEMA, {"mode": "PERMISSIVE",
                                               "columnNameOfCorruptRecord": _CORRUPT})
    # ``inline`` of a one-element array turns the struct into columns in a
    # Generate node: filters on the fields cannot be pushed below it, so the
    # JSON is parsed exactly once per message (no copies of from_json).
    out = raw.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
                     text.alias("value"),
                     F.inline(F.array(F.coalesce(parsed, F.struct(*[
                         # not a JSON object (or no value): all fields NULL,
                         # the text kept as the corrupt record
                         (F.coalesce(text, F.lit("")) if f.name == _CORRUPT else F.lit(None).cast("string"))
                         .alias(f.name) for f in _PARSE_SCHEMA.fields])))))
    bad = F.col("value").isNull() | F.col(_CORRUPT).isNotNull()
    return out.select("key", "value", *MESSAGE_FIELDS, bad.alias("_bad_json"))


# What a cast to double takes beside decimal numbers: type suffixes and hexadecimal digits.
_NOT_DECIMAL = r"[0-9.][dDfF]\s*$|^\s*[+-]?0[xX]"


# ING6
def coerce_numeric(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Text -> double; anything unparsable is NULL, a type suffix (``1.5d``) or a hexadecimal number too."""
    return df.withColumns({c: F.when(~F.col(c).rlike(_NOT_DECIMAL), F.col(c).try_cast("double")) for c in columns})


# ING7
def parse_time(text: Column) -> Column:
    """ISO-8601 text -> ``timestamp``, UTC if it names no zone; NULL if unparsable or without a date."""
    text = F.trim(text)
    # with a zone of its own, a second one makes the text unparsable
    named = F.concat(text, F.lit("Z")).try_cast("timestamp")
    day = F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp")
    parsed = F.when(text.endswith("Z"), text.try_cast("timestamp")).otherwise(F.coalesce(named, day, text.try_cast("timestamp")))
    return F.when(~text.rlike(r"^[Tt]?[0-9]{1,2}:"), parsed)


# ``RECEIVED_FORMAT`` as a pattern.
_RECEIVED = r"^[0-9]{2}-[0-9]{2}-[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}$"


# ING8
def parse_received(text: Column) -> Column:
    """``dd-MM-yyyy HH:mm:ss.SSSSSS`` text -> ``timestamp_ntz``, NULL if unparsable."""
    part = lambda at, n: F.substring(text, at, n)
    iso = F.concat(part(7, 4), F.lit("-"), part(4, 2), F.lit("-"), part(1, 2), F.lit(" "), part(12, 15))
    return F.when(text.rlike(_RECEIVED), iso.try_cast(T.TimestampNTZType()))


# ING9
def derive_partition(df: DataFrame) -> DataFrame:
    """``year/month/day`` (UTC) from ``time``, or from ``recieved`` when ``time`` is NULL."""
    d = F.coalesce(*[utc_date(F.col(c), type_of(df, c)) for c in ("time", "recieved")])
    return (df.withColumn("year", F.year(d)).withColumn("month", F.month(d))
              .withColumn("day", F.dayofmonth(d)))


# ING13
def normalize_side(df: DataFrame) -> DataFrame:
    return df.withColumn("side", _normalize_side("side"))


def validate(decoded: DataFrame) -> DataFrame:
    """Typed tick columns plus ``reason`` (NULL for a good row) and ``is_ticker``.

    Rows of another ``type`` are not errors: ``is_ticker`` is false and they
    are dropped (ING1).
    """
    typed = coerce_numeric(decoded)
    t_txt, r_txt = F.col("time"), F.col("Recieved")
    ints = {c: F.col(c).try_cast("bigint") for c in INTEGER_COLUMNS}
    typed = (typed.withColumn("_time", parse_time(t_txt))
                  .withColumn("_recv", parse_received(r_txt))
                  .withColumns({"_" + c: e for c, e in ints.items()}))
    bad_int = None
    for c in INTEGER_COLUMNS:
        cond = F.col(c).isNotNull() & F.col("_" + c).isNull()
        bad_int = cond if bad_int is None else (bad_int | cond)
    is_ticker = F.coalesce(F.col("type"), F.lit("")) == TICKER_TYPE
    reason = (F.when(F.col("_bad_json"), F.lit(BAD_JSON))
              .when(~is_ticker, F.lit(None).cast("string"))
              .when(t_txt.isNotNull() & F.col("_time").isNull(), F.lit(BAD_TIME))
              .when(r_txt.isNotNull() & F.col("_recv").isNull(), F.lit(BAD_RECEIVED))
              .when(bad_int, F.lit(BAD_INTEGER))
              .when(F.col("_time").isNull() & F.col("_recv").isNull(), F.lit(NO_DATE)))
    out = typed.select(
        "key", "value",
        F.col("type"), F.col("_sequence").alias("sequence"), F.col("product_id"),
        *[F.col(c) for c in NUMERIC_COLUMNS],
        F.col("side"), F.col("_time").alias("time"), F.col("_trade_id").alias("trade_id"),
        F.col("_recv").alias("recieved"),
        reason.alias("reason"),
        is_ticker.alias("is_ticker"),
    )
    return derive_partition(out)


def good_ticks(validated: DataFrame) -> DataFrame:
    """Typed tick rows that passed (ING1 applied), with ``year/month/day``."""
    return (validated.where(F.col("reason").isNull() & F.col("is_ticker"))
            .select(*TICK_COLUMNS, "year", "month", "day"))


def dead_letters(validated: DataFrame) -> DataFrame:
    """``key, reason, value``: rows that could not be typed (SNK2 payload)."""
    return validated.where(F.col("reason").isNotNull()).select("key", "reason", "value")


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("processed"), F.count_if(F.col("reason").isNotNull()).alias("errors"),
            F.count_if(F.col("reason").isNull() & ~F.col("is_ticker")).alias("dropped")]


def _with_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("error_pct", F.coalesce(
        F.round(F.try_divide(F.col("errors") * F.lit(100.0), F.col("processed")), 2), F.lit(0.0)))


# ING10
def ingest_metrics(validated: DataFrame) -> DataFrame:
    """One row: processed, errors, dropped (non-ticker), error_pct (2 dp, 0 if none)."""
    return _with_share(validated.agg(*_counts()))


def observed(validated: DataFrame) -> tuple[DataFrame, Observation]:
    """``validated`` as it is, with its counts observed by whatever job reads it first and whole."""
    seen = Observation()
    return validated.observe(seen, *_counts()), seen


def observed_metrics(spark: SparkSession, seen: Observation) -> DataFrame:
    """``ingest_metrics`` from an observation whose job has ended."""
    names = ("processed", "errors", "dropped")
    return _with_share(spark.createDataFrame([tuple(int(seen.get[n]) for n in names)], ", ".join(f"{n} long" for n in names)))


def ingest(raw: DataFrame) -> DataFrame:
    """ING4-ING9 in one step: raw key/value -> validated frame."""
    return validate(decode_messages(raw))


# ING12
def stamp_consumed_stored(df: DataFrame) -> DataFrame:
    """Optional consumer and store clocks (not part of the stored schema)."""
    now = F.current_timestamp()
    return df.withColumn("Consumed", now).withColumn("Stored", now)


# ING14
def filter_subscribed(ticks: DataFrame, subscriptions) -> DataFrame:
    """Only subscribed symbols.

    A list of symbols becomes an ``IN`` predicate (pushed to the scan and to
    partition pruning, no join). A DataFrame of ``product_id`` (static) is a
    left-semi join, planned by Spark from the size it knows. On a stream, ``streaming.subscribed`` reads the set anew for each micro-batch.
    """
    if isinstance(subscriptions, (list, tuple, set, frozenset)):
        return ticks.where(F.col("product_id").isin(sorted(subscriptions)))
    return ticks.join(subscriptions.select("product_id"), "product_id", "left_semi")


def subscriptions_frame(spark: SparkSession, symbols: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in symbols], "product_id string")


# ING15
def subscription_diff(wanted: DataFrame, active: DataFrame) -> DataFrame:
    """``product_id, action``: ``add`` for wanted-not-active, ``remove`` for active-not-wanted."""
    w = wanted.select("product_id").distinct()
    a = active.select("product_id").distinct()
    to_add = w.join(a, "product_id", "left_anti").withColumn("action", F.lit("add"))
    to_remove = a.join(w, "product_id", "left_anti").withColumn("action", F.lit("remove"))
    return to_add.unionByName(to_remove)
