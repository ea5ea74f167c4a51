"""Previous-row values over an ordered key without one task per key.

``lag`` over ``Window.partitionBy(key)`` moves every row of a key into one
task; a hot symbol holding a third of all ticks would then be one task.
Here the order is cut into chunks (a column that grows with the order, such
as the day or ``sequence // width``): ``lag`` runs per (key, chunk), and only
the first row of each chunk takes its predecessor from the last row of the
previous non-empty chunk, in a second window over first and last rows alone.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_chunked(df: DataFrame, keys: Sequence[str], chunk: Column | str,
                order: Sequence[str], values: Sequence[str],
                prefix: str = "prev_") -> DataFrame:
    """Add ``prefix+v`` = value of ``v`` on the previous row, for each ``v``.

    ``order`` (column names, ascending) sorts rows inside a chunk; chunks are
    ordered by ``chunk``, which must be non-decreasing along ``order``. Rows
    with a NULL chunk form their own chunk and take no predecessor from
    other chunks.

    Plan: one scan and one shuffle of the rows on (keys, chunk); the rows at the
    ends of the chunks, two for each, come from the same shuffled rows and are
    shuffled once more on the keys.
    """
    keys, order = list(keys), list(order)
    marked = df.withColumn("_chunk", F.col(chunk) if isinstance(chunk, str) else chunk)
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    main = marked.withColumns({prefix + v: F.lag(v).over(within) for v in values})
    main = main.withColumns({"_first": F.lag(F.lit(1)).over(within).isNull(), "_last": F.lead(F.lit(1)).over(within).isNull()})
    # both parts need all columns, so that they share one exchange
    ends = Window.partitionBy(*keys, F.col("_chunk").isNull()).orderBy("_chunk", *order)
    edges = main.filter("_first or _last").withColumns({prefix + v: F.lag(v).over(ends) for v in values})
    out = main.filter("not _first").unionByName(edges.filter("_first"))
    return out.drop("_chunk", "_first", "_last")
