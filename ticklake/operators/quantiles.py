"""Exact quantiles (linear interpolation) by narrowing brackets, without one task per group.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a group holding a third of the rows (or a column of unique values
such as ``sequence``) ends in one task. Here two passes read the values:

1. one aggregate per group takes count, moments, extremes and, for each
   probability, two approximate quantiles a little below and above it: a
   bracket that holds the needed order statistics but for one rank;
2. values inside a bracket are counted by value, those between the brackets
   as one interval with its count and extremes. Both combine map-side, so a
   task sends what lies in the brackets, a few ``1 / accuracy`` parts of
   its values, and one row for each interval.

Running counts over these few rows give each value and interval its rank span.
An order statistic lies in a bracket, or is the next value beside it, an extreme
of an interval. The quantile is ``v[lo] + (h - lo) * (v[lo + 1] - v[lo])`` with
``h = (n - 1) p``. How the values are spread does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.session import cut

ACCURACY = 20_000
#: Up to so many (group, column) rows of some hundred bytes, brackets go to every task; beyond it, Spark plans the join.
BROADCAST_ROWS = 100_000


def long_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *more: str) -> DataFrame:
    """``keys..., more..., column, value``: one row per non-NULL, non-NaN value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in columns])
    return (df.select(*keys, *more, F.inline(cells))
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def _first_pass(df: DataFrame, keys: list[str], columns: Sequence[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """``keys..., column, count, mean, std, min, max, q``; q: the two ends of each bracket in turn."""
    ends = [min(1.0, max(0.0, p + side * 2.0 / accuracy)) for p in probs for side in (-1, 1)]

    def stats(c: str) -> Column:
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        return F.struct(F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                        F.min(v).alias("min"), F.max(v).alias("max"), F.percentile_approx(v, ends, accuracy).alias("q"))

    wide = df.groupBy(*keys).agg(*[stats(c).alias(f"_{i}") for i, c in enumerate(columns)])
    return wide.select(*keys, F.inline(F.array(*[f"_{i}" for i in range(len(columns))]))).where("count > 0")


def summary(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float], names: Sequence[str] | None = None,
            accuracy: int = ACCURACY) -> DataFrame:
    """``keys..., column, count, mean, std, min, <name per prob>, max``; the quantiles are exact.

    ``keys`` hold no NULL. NULL and NaN values are not counted; a column without others has no row.
    """
    keys = list(keys)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    # used twice; at most one row for each group and column
    first = cut(_first_pass(df, keys, columns, [probs[i] for i in order], accuracy))
    g = [*keys, "column"]
    brackets = first.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("column", "q"))).alias("_q"))
    if first.count() <= BROADCAST_ROWS:
        brackets = F.broadcast(brackets)
    rows = long_values(df.select(*keys, *dict.fromkeys(columns)).join(brackets, keys), keys, columns, "_q")
    q = F.col("_q")[F.col("column")]
    v = F.col("value")
    lows, highs = [q[2 * i] for i in range(len(probs))], [q[2 * i + 1] for i in range(len(probs))]
    inside = F.lit(False)
    past = F.lit(0)
    for lo, hi in zip(lows, highs):
        inside = inside | ((v >= lo) & (v <= hi))
        past = past + (v > hi).cast("int")
    spans = (rows.select(*g, "value", F.when(inside, v).alias("_v"), F.when(~inside, past).alias("_between"))
             .groupBy(*g, "_v", "_between").agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi")))
    before = Window.partitionBy(*g).orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(first.drop("q"), g)

    def at(rank: Column) -> Column:
        """The value of that rank, where this span holds it."""
        last = F.col("_start") + F.col("_n") - 1
        one = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.raise_error(F.lit("an order statistic outside its bracket")).cast("double"))
        return F.when(rank == F.col("_start"), F.col("_lo")).when(rank == last, F.col("_hi")).when((rank > F.col("_start")) & (rank < last), one)

    picks, out = [], {}
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (F.col("count") - 1) * F.lit(float(p))
        lo = F.floor(h)
        picks += [F.max(at(lo)).alias(f"_a{i}"), F.max(at(F.least(lo + 1, F.col("count") - 1))).alias(f"_b{i}")]
        out[name] = F.col(f"_a{i}") + (h - lo) * (F.col(f"_b{i}") - F.col(f"_a{i}"))
    moments = ["count", "mean", "std", "min", "max"]
    res = spans.groupBy(*g).agg(*[F.first(c).alias(c) for c in moments], *picks)
    return res.select(*g, "count", "mean", "std", "min", *[e.alias(n) for n, e in out.items()], "max")


def exact_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float], names: Sequence[str] | None = None,
                    accuracy: int = ACCURACY) -> DataFrame:
    """``keys..., column, <name per prob>``: the quantiles of ``summary`` alone."""
    return summary(df, keys, columns, probs, names, accuracy).drop("count", "mean", "std", "min", "max")
