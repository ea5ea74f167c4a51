"""SS1/SS2: top of book and recent quotes on a tick stream.

SS1 is a streaming aggregation (state: one row per symbol). SS2 keeps state
on two levels. Each (symbol, salt) holds the latest ``depth + 1`` quotes of its
share of the symbol's ticks in ``applyInPandasWithState`` and emits them when
they change; ``current_recent_quotes`` combines the last emission of every share, at
most ``salts * (depth + 1)`` rows a symbol. A hot symbol is thus spread over ``salts``
tasks. A late tick is merged by ``(time, sequence)``, so the result equals
the batch form over everything seen so far. Times are kept as microseconds, so that no
session time zone comes in between.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ticklake.functions.timecols import type_of
from ticklake.operators.book import QUOTE_FIELDS
from ticklake.schema import RECENT_QUOTES

SALTS = 16
_Q = [dst for _, dst in QUOTE_FIELDS]

EMITTED_SCHEMA = T.StructType(
    [T.StructField("product_id", T.StringType()), T.StructField("salt", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in _Q]
    + [T.StructField("micros", T.LongType()), T.StructField("sequence", T.LongType()), T.StructField("version", T.LongType())])

_STATE_SCHEMA = T.StructType(
    [T.StructField(c, T.ArrayType(T.DoubleType())) for c in _Q]
    + [T.StructField("micros", T.ArrayType(T.LongType())), T.StructField("sequence", T.ArrayType(T.LongType())),
       T.StructField("version", T.LongType())])


def _quotes(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("time").isNotNull()).select(
        "product_id", *[F.col(s).alias(d) for s, d in QUOTE_FIELDS], "time", "sequence")


# SS1
def stream_top_of_book(ticks: DataFrame) -> DataFrame:
    """Latest quote per symbol (``complete`` or ``update`` output mode)."""
    q = _quotes(ticks)
    quote = F.struct(*[F.col(c) for c in _Q], F.col("time"), F.col("sequence"))
    return (q.groupBy("product_id")
            .agg(F.max_by(quote, F.struct("time", "sequence")).alias("q"))
            .select("product_id", "q.*"))


def _latest(parts: list[dict[str, list]], keep: int) -> dict[str, list]:
    """The ``keep`` latest quotes of some lists of them, latest first; a quote without a sequence is before one with."""
    cols = [*_Q, "micros", "sequence"]
    rows = [r for p in parts for r in zip(*(p[c] for c in cols))]
    rows.sort(key=lambda r: (r[-2], r[-1] is not None, r[-1] or 0), reverse=True)
    return {c: [r[i] for r in rows[:keep]] for i, c in enumerate(cols)}


def _plain(frame: pd.DataFrame, keep: int) -> dict[str, list]:
    """The rows of a batch that can be among the ``keep`` latest, as lists with None for what is missing."""
    if len(frame) > keep:
        least = np.partition(frame["micros"].to_numpy(), len(frame) - keep)[len(frame) - keep]
        frame = frame[frame["micros"] >= least]
    whole = {"micros", "sequence"}
    return {c: [None if pd.isna(x) else int(x) if c in whole else float(x) for x in frame[c]] for c in [*_Q, "micros", "sequence"]}


def _recent_fn(depth: int):
    keep = depth + 1

    def update(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        cols = [*_Q, "micros", "sequence"]
        old = dict(zip([*cols, "version"], state.get)) if state.exists else {**{c: [] for c in cols}, "version": 0}
        top = {c: [None if x is None or x != x else x for x in old[c]] for c in cols}
        # one Arrow batch at a time: memory stays at a batch and ``keep`` rows, however many ticks there are
        for chunk in batches:
            top = _latest([top, _plain(chunk, keep)], keep)
        version = int(old["version"]) + 1
        state.update((*[top[c] for c in cols], version))
        out = pd.DataFrame({"product_id": key[0], "salt": key[1], **{c: pd.Series(top[c], dtype="float64") for c in _Q},
                            **{c: pd.Series(top[c], dtype="Int64") for c in ("micros", "sequence")}})
        out["version"] = version
        yield out[[f.name for f in EMITTED_SCHEMA.fields]]

    return update


# SS2
def stream_recent_quotes(ticks: DataFrame, depth: int = RECENT_QUOTES, salts: int = SALTS) -> DataFrame:
    """Per update of a (symbol, salt): its ``depth + 1`` latest quotes (``append`` mode).

    Each emission carries ``version`` (the update count of the share); ``current_recent_quotes`` makes the answer of them.
    """
    q = _quotes(ticks)
    kind = type_of(q, "time")
    at = F.unix_micros("time") if isinstance(kind, T.TimestampType) else (
        F.unix_date(F.col("time").cast("date")).cast("long") * 86_400_000_000
        + (F.hour("time") * 3600 + F.minute("time") * 60).cast("long") * 1_000_000
        + (F.expr("extract(SECOND FROM time)") * 1_000_000).cast("long"))
    salt = F.pmod(F.xxhash64("time", "sequence"), F.lit(salts)).cast("int")
    return (q.select("product_id", salt.alias("salt"), *_Q, at.alias("micros"), "sequence").groupBy("product_id", "salt")
            .applyInPandasWithState(_recent_fn(depth), EMITTED_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout))


def current_recent_quotes(emitted: DataFrame, depth: int = RECENT_QUOTES) -> DataFrame:
    """From the appended SS2 output, the ``depth`` quotes before each symbol's latest, newest first (``rank`` 1..depth).

    Each share counts by its last emission alone. Columns as in the batch form; ``time`` is a ``timestamp``.
    """
    last = F.max("version").over(Window.partitionBy("product_id", "salt"))
    live = emitted.withColumn("_last", last).where("version = _last")
    newest = Window.partitionBy("product_id").orderBy(F.col("micros").desc(), F.col("sequence").desc())
    return (live.withColumn("rn", F.row_number().over(newest)).where((F.col("rn") >= 2) & (F.col("rn") <= depth + 1))
            .select("product_id", (F.col("rn") - 1).alias("rank"), *_Q, F.timestamp_micros("micros").alias("time"), "sequence"))
