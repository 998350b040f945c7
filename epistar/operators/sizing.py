"""Size-checked broadcasting.

A side is broadcast only when its row count is proven to be within a bound.
The check is ``limit(bound + 1).count()``, which stops reading once the bound
is exceeded. Beyond the bound the plain frame is returned and Spark plans a
shuffle join (with AQE free to convert it later from runtime statistics).

Use it for sides read from storage (lookups, dimensions). For sides derived
from a shuffle (distinct names, aggregates), leave the decision to AQE, which
measures the materialised shuffle output before choosing a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the default row bound of a broadcast side.
LOOKUP_MAX_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
