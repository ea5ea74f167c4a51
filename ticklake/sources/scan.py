"""SRC1/SRC2: read the partitioned tick table and slice it by day and symbol."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.params import day_bounds, symbols_predicate, ts_literal, validate_symbols
from ticklake.schema import TICK_TABLE_SCHEMA
from ticklake.sources.layout import DAY_COLUMNS, day_paths


def read_batches(spark: SparkSession, root: str, paths: list[str], file_glob: str | None = "*.parquet") -> DataFrame:
    """The files below ``paths``, listed now, with the keys of their directories under ``root`` as columns."""
    if not paths:
        return spark.createDataFrame([], T.StructType([*TICK_TABLE_SCHEMA.fields, T.StructField("batch", T.StringType())]))
    reader = spark.read.schema(TICK_TABLE_SCHEMA).option("basePath", root)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.parquet(*paths)


def scan_ticks(spark: SparkSession, root: str, days=None, settled: bool = False, file_glob: str | None = "*.parquet") -> DataFrame:
    """The tick files under ``root`` (``year=/month=/day=/batch=/product_id=`` layout).

    The schema is fixed, never inferred; ``basePath`` makes the Hive keys columns, so day and symbol predicates become
    ``PartitionFilters``. With ``days`` (a day, an inclusive pair, or a list), only the directories of those days are
    listed. ``settled`` leaves out batches that a compaction has replaced and not deleted yet.
    """
    df = read_batches(spark, root, day_paths(spark, root, days), file_glob)
    if settled:
        from ticklake.sources.compaction import left_over

        df = df.join(left_over(spark, root, days), [*DAY_COLUMNS, "batch"], "left_anti")
    # the ``batch=`` directory (a micro-batch or a compaction) is bookkeeping, not data
    return df.drop("batch").select(*TICK_TABLE_SCHEMA.names)


def _time_bound(ticks: DataFrame, start: datetime, end: datetime):
    dtype = ticks.schema["time"].dataType
    t = F.col("time")
    # Partitions are cut by event time, so a day slice also bounds ``time``;
    # rows without a time (dated by their receive stamp) are kept.
    return ((t >= ts_literal(start, dtype)) & (t < ts_literal(end, dtype))) | t.isNull()


def scan_day(ticks: DataFrame, day: date | datetime | str, symbols=None) -> DataFrame:
    """One calendar day (``year``/``month``/``day``), optionally some symbols.

    The day predicate prunes partitions; the implied ``time`` bound reaches
    the Parquet reader as a pushed filter, also for derived tick frames.
    """
    syms = validate_symbols(symbols)
    start, end = day_bounds(day)
    pred = ((F.col("year") == start.year) & (F.col("month") == start.month)
            & (F.col("day") == start.day))
    return ticks.where(pred & _time_bound(ticks, start, end) & symbols_predicate(syms))


def scan_range(ticks: DataFrame, first_day, last_day, symbols=None) -> DataFrame:
    """Days ``first_day``..``last_day`` inclusive, optionally some symbols."""
    syms = validate_symbols(symbols)
    start, _ = day_bounds(first_day)
    _, end = day_bounds(last_day)
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    lo = start.year * 10000 + start.month * 100 + start.day
    last = day_bounds(last_day)[0]
    hi = last.year * 10000 + last.month * 100 + last.day
    return ticks.where(key.between(lo, hi) & _time_bound(ticks, start, end) & symbols_predicate(syms))


def _foreign_schema():
    from pyspark.sql import types as T

    from ticklake.schema import TICK_SCHEMA

    fields = []
    for f in TICK_SCHEMA.fields:
        if f.name == "time":
            fields.append(T.StructField("time", T.LongType()))  # nanoseconds since epoch
        elif f.name == "recieved":
            fields.append(T.StructField("Recieved", T.TimestampNTZType()))
        else:
            fields.append(f)
    return T.StructType(fields + [T.StructField("year", T.IntegerType()),
                                  T.StructField("month", T.IntegerType()),
                                  T.StructField("day", T.IntegerType())])


def scan_foreign_ticks(spark: SparkSession, root: str,
                       file_glob: str = "*.snappy.parquet") -> DataFrame:
    """Existing tick files in the older layout: ``year=/month=/day=/<SYMBOL>/``.

    The symbol directory there is not a Hive key (``product_id`` comes from
    the file body), zero-padded ``month``/``day`` parse as integers, and
    ``time`` is stored in nanoseconds, which Spark's Parquet reader only
    accepts as a long (``nanosAsLong``, a setting of the whole session); it is turned into a ``timestamp``
    here. The result has the same columns as ``scan_ticks``.
    """
    from ticklake.schema import TICK_COLUMNS

    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    raw = (spark.read.schema(_foreign_schema()).option("basePath", root)
           .option("pathGlobFilter", file_glob).parquet(root))
    cols = []
    for c in TICK_COLUMNS:
        if c == "time":
            cols.append(F.timestamp_micros(F.floor(F.col("time") / 1000)).alias("time"))
        elif c == "recieved":
            cols.append(F.col("Recieved").alias("recieved"))
        else:
            cols.append(F.col(c))
    return raw.select(*cols, "year", "month", "day")
