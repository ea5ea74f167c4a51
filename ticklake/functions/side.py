"""Trade side normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Side names; "sell_short" is an alias of "sell".
SELL, BUY, SELL_SHORT = "sell", "buy", "sell_short"


def normalize_side(side: Column | str) -> Column:
    """``sell``/``buy`` in lower case; ``sell_short`` maps to ``sell``; else NULL."""
    s = F.lower(F.trim(F.col(side) if isinstance(side, str) else side))
    return F.when(s.isin(SELL, SELL_SHORT), SELL).when(s == BUY, BUY)
