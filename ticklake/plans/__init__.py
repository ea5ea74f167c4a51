"""Analytical queries (Q1-Q19) as DataFrame functions."""

from ticklake.plans.analytics import (  # noqa: F401
    correlation, dataset, day_extract, describe_ticks, high_low, latest_prices, quickvwap,
    returns, symbols_on_date, volatility, vwap, vwap_on_date,
)
from ticklake.plans.reports import (  # noqa: F401
    gap_series, mean_gap, resample_mean, sequence_gaps, volatility_crosstab,
    volatility_events, volatility_levels,
)
