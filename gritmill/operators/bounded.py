"""Broadcast only behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_below(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged (a shuffle join follows)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
