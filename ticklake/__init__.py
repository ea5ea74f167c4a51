"""ticklake: market-tick analytics as Spark DataFrame functions.

Ticks live as date- and symbol-partitioned Parquet (or are derived from any
DataFrame with the tick columns). Every operator takes and returns a
``DataFrame``; nothing is collected to the driver.
"""

__version__ = "0.1.0"
