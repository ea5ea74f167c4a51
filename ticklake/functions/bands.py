"""Reading aids for returns, volatility and correlation (documented bands)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Band edges and names.
# ---------------------------------------------------------------------------
# Volatility (std-dev of minute log returns); each band is [lower, upper).
VOLATILITY_BANDS = [
    (0.0005, 0.003, "quiet"),
    (0.003, 0.01, "typical"),
    (0.01, 0.02, "active"),
    (0.02, 0.05, "highly volatile"),
]
VOLATILITY_EXTREME = (0.05, "extreme")  # strictly above
# Correlation readings.
CORRELATION_TOGETHER = (0.5, "typically together")  # strictly above
CORRELATION_OPPOSITE = (-0.5, "typically opposite")  # strictly below
CORRELATION_PERFECT = "perfectly together"  # exactly 1
CORRELATION_PERFECT_OPPOSITE = "perfect opposites"  # exactly -1
CORRELATION_NONE = "none"  # exactly 0
CORRELATION_WEAK = "weak"  # anything else (our name)
# Return direction.
DIRECTION_UP, DIRECTION_DOWN, DIRECTION_FLAT = "up", "down", "flat"
# ---------------------------------------------------------------------------

_EPS = 1e-12


def return_direction(ret: Column | str) -> Column:
    """``up`` for a positive log return, ``down`` for a negative one."""
    r = F.col(ret) if isinstance(ret, str) else ret
    return (F.when(r > 0, DIRECTION_UP).when(r < 0, DIRECTION_DOWN)
            .when(r == 0, DIRECTION_FLAT))


def volatility_band(vol: Column | str) -> Column:
    """Band name of a volatility value; below the quiet band it is NULL."""
    v = F.col(vol) if isinstance(vol, str) else vol
    expr = F.when(v > VOLATILITY_EXTREME[0], VOLATILITY_EXTREME[1])
    for lower, upper, name in reversed(VOLATILITY_BANDS):
        expr = expr.when((v >= lower) & (v < upper), name)
    # exactly the top edge belongs to the band below "extreme"
    return expr.when(v == VOLATILITY_EXTREME[0], VOLATILITY_BANDS[-1][2])


def correlation_band(corr: Column | str) -> Column:
    """Reading of a correlation coefficient."""
    c = F.col(corr) if isinstance(corr, str) else corr
    return (F.when(F.abs(c - 1) <= _EPS, CORRELATION_PERFECT)
            .when(F.abs(c + 1) <= _EPS, CORRELATION_PERFECT_OPPOSITE)
            .when(c > CORRELATION_TOGETHER[0], CORRELATION_TOGETHER[1])
            .when(c < CORRELATION_OPPOSITE[0], CORRELATION_OPPOSITE[1])
            .when(F.abs(c) <= _EPS, CORRELATION_NONE)
            .when(c.isNotNull(), CORRELATION_WEAK))
