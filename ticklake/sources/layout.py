"""Directories of the tick table: ``year=/month=/day=/batch=/product_id=``.

``batch`` is one write: a micro-batch, an append, or a compaction (``c`` and a time). It stands above the symbol, so that what
one write left in a day is one directory.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.params import day_bounds

WRITE_COLUMNS = ["year", "month", "day", "batch", "product_id"]
DAY_COLUMNS = ["year", "month", "day"]
LISTING_SCHEMA = "year int, month int, day int, batch string, product_id string, path string, length long"


def file_system(spark: SparkSession, path: str):
    """(file system, path, the JVM's Path class) of ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = file_system(spark, path)
    return fs.exists(p)


def day_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/year={day.year}/month={day.month}/day={day.day}"


def days_of(days) -> list[date]:
    """Calendar days of one day, an inclusive ``(first, last)`` pair or a list."""
    if isinstance(days, tuple):
        first, last = (day_bounds(d)[0].date() for d in days)
        return [first + timedelta(days=i) for i in range((last - first).days + 1)]
    if isinstance(days, (date, datetime, str)):
        days = [days]
    return [day_bounds(d)[0].date() for d in days]


def day_paths(spark: SparkSession, root: str, days) -> list[str]:
    """The directories of ``days`` that exist; all of ``root`` if ``days`` is None."""
    if days is None:
        return [root] if exists(spark, root) else []
    return [p for p in (day_path(root, d) for d in days_of(days)) if exists(spark, p)]


def listing(spark: SparkSession, root: str, days: Iterable | tuple | None = None) -> DataFrame:
    """One row for each data file of ``days``, from the file listing alone: no file is opened.

    Names that start with ``_`` or ``.`` are not listed.
    """
    paths = day_paths(spark, root, days)
    if not paths:
        return spark.createDataFrame([], LISTING_SCHEMA)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(paths).select("path", "length"))

    def part(name: str):
        # values are escaped with %XX in the path, where a plus sign is just that
        raw = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))

    keys = [part(c).cast("int").alias(c) for c in DAY_COLUMNS] + [part(c).alias(c) for c in ("batch", "product_id")]
    return files.select(*keys, "path", "length")
