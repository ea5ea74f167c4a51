"""Q20/Q21: top of book per symbol and the quotes before it (batch form).

Arrival order is ``(time, sequence)``. The latest quote is one ``max_by``
aggregate (combined map-side); the recent quotes are a per-symbol top-k,
planned as a partial + final ``WindowGroupLimit`` so each map task keeps
at most ``k`` rows per symbol before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.schema import RECENT_QUOTES

QUOTE_FIELDS = [("best_bid", "bid"), ("best_bid_size", "bid_size"),
                ("best_ask", "ask"), ("best_ask_size", "ask_size")]


def _quote_cols():
    return [F.col(src).alias(dst) for src, dst in QUOTE_FIELDS]


def top_of_book(ticks: DataFrame) -> DataFrame:
    """``product_id, bid, bid_size, ask, ask_size, time, sequence`` of the latest tick."""
    quote = F.struct(*_quote_cols(), F.col("time"), F.col("sequence"))
    return (ticks.where(F.col("time").isNotNull())
            .groupBy("product_id")
            .agg(F.max_by(quote, F.struct("time", "sequence")).alias("q"))
            .select("product_id", "q.*"))


def recent_quotes(ticks: DataFrame, depth: int = RECENT_QUOTES) -> DataFrame:
    """The ``depth`` quotes before the latest, newest first (``rank`` 1..depth)."""
    w = Window.partitionBy("product_id").orderBy(F.col("time").desc(), F.col("sequence").desc())
    return (ticks.where(F.col("time").isNotNull())
            .select("product_id", *_quote_cols(), "time", "sequence",
                    F.row_number().over(w).alias("rn"))
            .where((F.col("rn") >= 2) & (F.col("rn") <= depth + 1))
            .select("product_id", (F.col("rn") - 1).alias("rank"),
                    "bid", "bid_size", "ask", "ask_size", "time", "sequence"))
