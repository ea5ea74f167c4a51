"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns of a given table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder (for wide rows)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{os.urandom(6).hex()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c):
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running(df: DataFrame, key: str, order: list[str], value: str, out: str, total: str) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over earlier rows of the same ``key``, ``total``, the sum over all of them, and ``row``, an id.

    ``key`` holds no null; ``order`` counts nulls first. Rows are dealt by range and written in order, so that a hot key lies in
    many partitions; within one a window sums up, and one row per (partition, key) carries the sums of the partitions before.
    Rows with equal ``order`` are told apart by a seeded draw.
    """
    keys = [key, *order, "_salt"]
    by = [F.col(c).asc_nulls_first() for c in keys]
    rows = (df.withColumn("_salt", F.rand(17)).repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
            .withColumn("row", F.monotonically_increasing_id()))
    rows = written(rows, "running").withColumn("_part", F.shiftright("row", 33))
    within = Window.partitionBy("_part", key).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part", key).agg(F.sum(value).alias("_sum"))
    whole = Window.partitionBy(key)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", key, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"), F.sum("_sum").over(whole).alias(total))
    return (rows.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(offsets, ["_part", key]).withColumn(out, F.col("_within") + F.col("_before")).drop("_part", "_within", "_before"))


#: The unsigned CRC-32 of a text of ASCII characters, for DuckDB; {0} is the text. A fixed polynomial.
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda d, k: CASE WHEN d % 2 = 1 THEN xor(3988292384, d // 2) ELSE d // 2 END)))"""
