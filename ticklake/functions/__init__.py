"""Column expressions and parameter rules shared by the operators."""

from ticklake.functions.params import (  # noqa: F401
    day_bounds, symbols_predicate, timeframe_bounds, ts_literal, validate_symbol, validate_symbols,
)
from ticklake.functions.timecols import bucket_of, type_of, utc_date, utc_text, utc_wall  # noqa: F401
from ticklake.functions.bands import correlation_band, return_direction, volatility_band  # noqa: F401
from ticklake.functions.side import normalize_side  # noqa: F401
