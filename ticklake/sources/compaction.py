"""SNK4/SNK5: find symbol-days in many small files and rewrite them in few.

Compaction reads a fixed list of batch directories of closed days, rewrites them in one Spark job under a staging folder,
checks the row counts, and publishes each day by renaming one directory, the new batch. That rename is the commit. Before it,
the names of the batches that the new one replaces are added to a small table, ``_folded`` (year, month, day, batch, into); a row of it holds
once the directory of ``into`` is there. So

* a replay of a folded batch is not added again: ``append_ticks`` leaves out the days for which its batch is folded;
* a run that ends before the rename leaves the table as it was, and one that ends after it leaves directories that the next run
  deletes and ``scan_ticks(..., settled=True)`` does not read;
* batches that land meanwhile are in no list, so they stay.

Today is never touched. A symbol-day of many bytes becomes several files, cut by time at approximate quantiles.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schema import PARTITION_COLUMNS, TICK_COLUMNS
from ticklake.sources.layout import DAY_COLUMNS, WRITE_COLUMNS, day_path, days_of, exists, file_system, listing
from ticklake.sources.scan import read_batches

FOLDED = "_folded"
FOLDED_SCHEMA = "year int, month int, day int, batch string, into string"
STAGING = "_staging"
TARGET_BYTES = 256 << 20
#: A file below this share of the target is a fragment.
FRAGMENT_SHARE = 0.25
#: Days rewritten in one job; bounds the staging space.
DAYS_A_JOB = 31
_QUANTILES = 100


# SNK5
def fragmented_partitions(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, days=None) -> DataFrame:
    """``year, month, day, product_id, files, bytes`` of symbol-days with more fragments than packing them would leave.

    A fragment is a file below a quarter of ``target_bytes``; larger files are finished and not counted. The numbers come from
    the file listing; no row is read.
    """
    small = listing(spark, root, days).filter(F.col("length") < FRAGMENT_SHARE * target_bytes)
    found = small.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return found.filter(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target_bytes))))


def folded(spark: SparkSession, root: str) -> DataFrame:
    """The names of replaced batches, also those whose compaction was not published."""
    path = f"{root.rstrip('/')}/{FOLDED}"
    return spark.read.schema(FOLDED_SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], FOLDED_SCHEMA)


def folded_days(spark: SparkSession, root: str, batch: str) -> list[date]:
    """The days for which ``batch`` is part of a published compaction."""
    if not exists(spark, f"{root.rstrip('/')}/{FOLDED}"):
        return []
    rows = folded(spark, root).filter(F.col("batch") == batch).distinct().collect()
    return sorted({date(r["year"], r["month"], r["day"]) for r in rows
                   if exists(spark, f"{day_path(root, date(r['year'], r['month'], r['day']))}/batch={r['into']}")})


def left_over(spark: SparkSession, root: str, days=None) -> DataFrame:
    """``year, month, day, batch`` of directories that a published compaction replaces and that are still there."""
    there = listing(spark, root, days).select(*DAY_COLUMNS, "batch").distinct()
    replaced = folded(spark, root).join(there.withColumnRenamed("batch", "into"), [*DAY_COLUMNS, "into"], "left_semi")
    return replaced.select(*DAY_COLUMNS, "batch").distinct().join(there, [*DAY_COLUMNS, "batch"], "left_semi")


def _batch_path(root: str, r) -> str:
    return f"{day_path(root, date(r['year'], r['month'], r['day']))}/batch={quote(r['batch'], safe='+-_.')}"


def _delete(spark: SparkSession, paths: Iterable[str]) -> int:
    n = 0
    for path in paths:
        fs, p, _ = file_system(spark, path)
        n += bool(fs.delete(p, True))
    return n


def _packed(rows: DataFrame, sizes: DataFrame, target_bytes: int) -> DataFrame:
    """``rows`` dealt so that each symbol-day is one file, or several of about ``target_bytes`` that follow one another in time."""
    files = F.greatest(F.lit(1), F.floor(F.col("bytes") / F.lit(target_bytes))).cast("int")
    hot = sizes.withColumn("files", files).filter("files > 1").select(*PARTITION_COLUMNS, "files")
    at = F.unix_micros("time")
    quantiles = (rows.join(hot, PARTITION_COLUMNS, "left_semi").groupBy(*PARTITION_COLUMNS)
                 .agg(F.percentile_approx(at, [i / _QUANTILES for i in range(1, _QUANTILES)], 10 * _QUANTILES).alias("q")))
    cuts = quantiles.join(hot, PARTITION_COLUMNS).select(
        *PARTITION_COLUMNS, F.expr(f"transform(sequence(1, files - 1), i -> q[greatest(cast(floor(i * {_QUANTILES} / files) as int) - 1, 0)])").alias("cuts"))
    # a symbol-day without cuts is one file; a tick without a time goes to the first
    chunk = F.coalesce(F.size(F.filter("cuts", lambda c: c <= at)), F.lit(0))
    tasks = max(1, -(-int(sizes.agg(F.sum("bytes")).first()[0] or 0) // target_bytes))
    return (rows.join(cuts, PARTITION_COLUMNS, "left").withColumn("_chunk", chunk).drop("cuts")
            .repartition(tasks, *PARTITION_COLUMNS, "_chunk").sortWithinPartitions(*PARTITION_COLUMNS, "time", "sequence").drop("_chunk"))


def _publish(spark: SparkSession, staged: str, final: str) -> None:
    """One rename; the file system does it whole or not at all."""
    fs, src, path_class = file_system(spark, staged)
    dst = path_class(final)
    if not fs.exists(dst.getParent()) or not fs.rename(src, dst):
        raise OSError(f"could not move {staged}; the day is left as it was")


# SNK4
def compact_days(spark: SparkSession, root: str, days, today: date | None = None, target_bytes: int = TARGET_BYTES) -> dict[date, dict]:
    """Rewrite the fragments of closed days in one job; ``{day: {status, rows, batch}}``.

    Batches without a fragment of a symbol-day that needs packing are left alone. ``status`` is ``compacted``, ``already-compact``, ``missing``
    or ``skipped-today`` (today and later). Raises, with the table as it was, if the new files do not hold the same number of rows.
    """
    days, last = days_of(days), today or datetime.now(timezone.utc).date()
    out = {d: {"status": "skipped-today", "rows": 0} for d in days if d >= last}
    days = [d for d in days if d < last]
    _delete(spark, [_batch_path(root, r) for r in left_over(spark, root, days).collect()])
    files = listing(spark, root, days)
    there = {date(r["year"], r["month"], r["day"]) for r in files.select(*DAY_COLUMNS).distinct().collect()}
    out |= {d: {"status": "already-compact" if d in there else "missing", "rows": 0} for d in days}
    fragments = (files.filter(F.col("length") < FRAGMENT_SHARE * target_bytes)
                 .join(fragmented_partitions(spark, root, target_bytes, days), PARTITION_COLUMNS, "left_semi"))
    batches = fragments.select(*DAY_COLUMNS, "batch").distinct().collect()  # one row for each directory to be rewritten
    if not batches:
        return out
    stamp = "c" + datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    replaced = spark.createDataFrame([tuple(r) for r in batches], "year int, month int, day int, batch string")
    rows = read_batches(spark, root, [_batch_path(root, r) for r in batches]).select(*TICK_COLUMNS, *DAY_COLUMNS)
    sizes = files.join(replaced, [*DAY_COLUMNS, "batch"], "left_semi").groupBy(*PARTITION_COLUMNS).agg(F.sum("length").alias("bytes"))
    stage = f"{root.rstrip('/')}/{STAGING}/{stamp}"
    _packed(rows, sizes, target_bytes).withColumn("batch", F.lit(stamp)).write.partitionBy(*WRITE_COLUMNS).parquet(stage)

    def counted(df: DataFrame) -> dict[date, int]:
        return {date(r["year"], r["month"], r["day"]): r["n"] for r in df.groupBy(*DAY_COLUMNS).agg(F.count("*").alias("n")).collect()}

    n, written = counted(rows), counted(read_batches(spark, stage, [stage]))
    if n != written:
        raise RuntimeError(f"{written} of {n} rows rewritten; the days are left as they were")
    # what the replaced batches had replaced themselves is in the new one too
    earlier = folded(spark, root).join(replaced.withColumnRenamed("batch", "into"), [*DAY_COLUMNS, "into"], "left_semi").select(*DAY_COLUMNS, "batch")
    (replaced.unionByName(earlier).distinct().withColumn("into", F.lit(stamp)).coalesce(1)
        .write.mode("append").parquet(f"{root.rstrip('/')}/{FOLDED}"))
    for d in sorted(n):
        _publish(spark, f"{day_path(stage, d)}/batch={stamp}", f"{day_path(root, d)}/batch={stamp}")
        out[d] = {"status": "compacted", "rows": n[d], "batch": stamp}
    _delete(spark, [_batch_path(root, r) for r in batches if date(r["year"], r["month"], r["day"]) in n])
    _delete(spark, [stage])
    return out


def compact_day(spark: SparkSession, root: str, day: date | datetime | str, today: date | None = None, target_bytes: int = TARGET_BYTES) -> dict:
    """``compact_days`` for one day."""
    return compact_days(spark, root, [day], today, target_bytes)[days_of([day])[0]]


def clean_staging(spark: SparkSession, root: str, max_age_hours: float = 24.0) -> int:
    """Delete the staging folders of interrupted compactions older than ``max_age_hours``; younger ones may still be written."""
    fs, stage, _ = file_system(spark, f"{root.rstrip('/')}/{STAGING}")
    if not fs.exists(stage):
        return 0
    cutoff_ms = (datetime.now(timezone.utc).timestamp() - max_age_hours * 3600) * 1000
    return _delete(spark, [st.getPath().toString() for st in fs.listStatus(stage) if st.getModificationTime() <= cutoff_ms])


def compact_table(spark: SparkSession, root: str, today: date, target_bytes: int = TARGET_BYTES, staging_max_age_hours: float = 24.0) -> list[dict]:
    """Compact every closed day that has a fragmented symbol-day, ``DAYS_A_JOB`` days a job; one result for each day."""
    clean_staging(spark, root, staging_max_age_hours)
    old = left_over(spark, root).select(*DAY_COLUMNS)
    rows = fragmented_partitions(spark, root, target_bytes).select(*DAY_COLUMNS).unionByName(old).distinct().orderBy(*DAY_COLUMNS).collect()
    days = [date(*r) for r in rows]
    out = {}
    for at in range(0, len(days), DAYS_A_JOB):
        out |= compact_days(spark, root, days[at:at + DAYS_A_JOB], today, target_bytes)
    return [{"day": d.isoformat(), **r} for d, r in sorted(out.items())]
