"""Marketing events by channel and behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import Span
from tidemark.operators.windows import sliding_counts


def channel_behavior_counts(
    events: DataFrame, excluded: str = "UNINSTALL", size: Span = "1 hour", slide: Span = "5 seconds"
) -> DataFrame:
    """Events per channel, behaviour and sliding window, without ``excluded`` (missing behaviours stay)."""
    kept = events.where(~F.col("behavior").eqNullSafe(F.lit(excluded)))
    return sliding_counts(kept, "ts", size, slide, ["channel", "behavior"])
