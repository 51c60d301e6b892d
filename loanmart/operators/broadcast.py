"""Broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int, known_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Return (df marked for broadcast, True) when its row count is within ``max_rows``.

    ``known_rows`` is used when the caller knows the size at planning time
    (lookups built on the driver); otherwise one count job is run on the
    lookup side only. Beyond the limit the DataFrame is returned unmarked and
    the caller must use a shuffle-based plan.
    """
    n = known_rows if known_rows is not None else df.count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False
