"""Tick schema and the fixed values the analytics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# The eleven numeric tick fields, coerced to double on ingest.
NUMERIC_COLUMNS = [
    "price", "open_24h", "volume_24h", "low_24h", "high_24h", "volume_30d",
    "best_bid", "best_bid_size", "best_ask", "best_ask_size", "last_size",
]
# Integer tick fields.
INTEGER_COLUMNS = ["sequence", "trade_id"]
# Column order of a tick row.
TICK_COLUMNS = [
    "type", "sequence", "product_id",
    *NUMERIC_COLUMNS,
    "side", "time", "trade_id", "recieved",
]
# Partition columns of the tick table, outermost first.
PARTITION_COLUMNS = ["year", "month", "day", "product_id"]
# Message type kept by the feed filter.
TICKER_TYPE = "ticker"
# Wall-clock stamp format of the "Recieved" field (Java pattern of %d-%m-%Y %H:%M:%S.%f).
RECEIVED_FORMAT = "dd-MM-yyyy HH:mm:ss.SSSSSS"
# Symbols must fully match this pattern.
SYMBOL_PATTERN = r"[a-zA-Z0-9-]+"
# Look-back timeframes in minutes; any other value means "since midnight".
TIMEFRAME_MINUTES = {"1h": 60, "30m": 30, "15m": 15, "5m": 5}
# Ordered volatility levels (code -> name).
VOLATILITY_LEVELS = {1: "NORMAL", 2: "HIGH", 3: "VERY_HIGH", 4: "EXTREME"}
# Replacement for a zero sequence gap before taking its logarithm.
ZERO_GAP = 0.001
# Topic name prefix of the daily tick topic.
TOPIC_PREFIX = "market-data-"
# Number of quotes kept before the latest one in the book.
RECENT_QUOTES = 10
# ---------------------------------------------------------------------------

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)

# Typed tick row as stored. ``time`` is an instant (UTC); ``recieved`` is the
# producer's wall clock without zone.
TICK_SCHEMA = T.StructType(
    [T.StructField("type", T.StringType()),
     T.StructField("sequence", T.LongType()),
     T.StructField("product_id", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC_COLUMNS]
    + [T.StructField("side", T.StringType()),
       T.StructField("time", T.TimestampType()),
       T.StructField("trade_id", T.LongType()),
       T.StructField("recieved", T.TimestampNTZType())]
)

# Schema of the partitioned table as read back: body columns plus the Hive keys.
TICK_TABLE_SCHEMA = T.StructType(
    [f for f in TICK_SCHEMA.fields if f.name != "product_id"]
    + [T.StructField("year", T.IntegerType()),
       T.StructField("month", T.IntegerType()),
       T.StructField("day", T.IntegerType()),
       T.StructField("product_id", T.StringType())]
)

# Every field of a feed message is read as text first, then cast; the wire
# name of the receive stamp keeps its original spelling and case.
MESSAGE_FIELDS = [c if c != "recieved" else "Recieved" for c in TICK_COLUMNS]
MESSAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MESSAGE_FIELDS])

LEVEL_NAMES_ABOVE_NORMAL = [VOLATILITY_LEVELS[k] for k in (2, 3, 4)]
