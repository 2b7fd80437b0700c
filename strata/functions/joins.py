"""Joins of a large table with a small set of coarse keys.

Joining ``entries`` or ``staging`` with a few (repository, branch) or
(repository, meta_range_id) keys must not hash-shuffle the large side on
those keys: one key could hold a third of all rows and end in one task.
The key side is broadcast only after its size was checked (a count of a
small, request-derived DataFrame); above the bound the join falls back to a
shuffle join, where AQE's skew-join handling splits hot partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed bounds: rows and bytes (as text) of a key side that may be broadcast.
MAX_BROADCAST_KEYS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


def small_side(keys: DataFrame, limit: int = MAX_BROADCAST_KEYS, most_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``keys`` with a broadcast hint if it has at most ``limit`` rows and
    ``most_bytes`` bytes in them.

    The check counts where the rows are: it moves a row a task, never the keys."""
    wide = F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))
    n, size = keys.agg(F.count(F.lit(1)), wide).first()
    return F.broadcast(keys) if n <= limit and size <= most_bytes else keys


def rows_among(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` that ``keys`` names in columns of ``df``, found once.

    Few keys are sent to the tasks that hold ``df`` and few found rows to those that
    ask, so that neither side of a lookup moves."""
    named = small_side(keys.dropna().distinct())
    return small_side(df.join(named, keys.columns, "left_semi").checkpoint(eager=True))
