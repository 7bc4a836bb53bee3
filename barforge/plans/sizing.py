"""Size-checked broadcast and partitioning helpers.

Two ways a side may be broadcast:

* ``bounded_broadcast``: Spark's own size estimate (file sizes and column
  pruning, no job) decides first; if the estimate is unknown or too large a
  bounded ``limit(max_rows + 1).count()`` confirms, which stops reading as
  soon as the bound is exceeded.  Above the bound the join stays a shuffle
  join and AQE (skew join, coalescing) takes over.
* ``broadcast_by_construction``: the relation's row count is bounded by how
  it is built (one row per calendar day of a fixed look-back window, one
  row per entrant); the bound is stated by the caller and no job is run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan (metadata only)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001  (no estimate available)
        return None


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if ``df`` is provably small, else unchanged (shuffle join)."""
    est = estimated_bytes(df)
    if est is not None and est <= max_bytes:
        return F.broadcast(df)
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def broadcast_by_construction(df: DataFrame, bound: str) -> DataFrame:
    """Broadcast a relation whose size bound follows from how it is built.

    ``bound`` documents the proof at the call site, e.g. "one row per
    calendar day of the 5-year window (<= 1,827)".
    """
    assert bound
    return F.broadcast(df)
