"""Sources and sinks of the tick table."""

from ticklake.sources.scan import scan_day, scan_foreign_ticks, scan_range, scan_ticks  # noqa: F401
