"""Stock side: the newest stock check per (store, product)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.schemas import KEYS


def complete_check() -> Column:
    """A check the replay and the stream can place: key, times and quantity are known."""
    known = F.lit(True)
    for c in (*KEYS, "arrived_at", "checked_at", "quantity"):
        known = known & F.col(c).isNotNull()
    return known


def stock_table(stocks: DataFrame, arrival: str = "arrived_at") -> DataFrame:
    """Newest check per key: the latest ``checked_at``; on a tie the later arrival,
    then the larger quantity (as in the replay and the stream).

    ``max_by`` is an ordinary aggregate, so Spark combines it map-side before
    the shuffle: a hot key costs one partial row per task, not its history.
    """
    rank = F.struct(*[c for c in ("checked_at", arrival, "quantity") if c in stocks.columns])
    cols = [c for c in stocks.columns if c not in KEYS]
    newest = F.max_by(F.struct(*cols), rank).alias("newest")
    return stocks.groupBy(*KEYS).agg(newest).select(*KEYS, "newest.*")
