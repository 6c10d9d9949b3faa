"""Item views, page flow, page views and visitors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import Span
from tidemark.operators import counting, lateness, ranking, windows

PAGE_VIEW = "pv"
READ_METHOD = "GET"


def _page_views(behavior: DataFrame) -> DataFrame:
    return behavior.where(F.col("behavior") == PAGE_VIEW)


def item_view_counts(behavior: DataFrame, size: Span = "1 hour", slide: Span = "5 minutes") -> DataFrame:
    """Views per item and sliding window (``user_id, item_id, behavior, ts``)."""
    return windows.sliding_counts(_page_views(behavior), "ts", size, slide, ["item_id"])


def hot_items(behavior: DataFrame, n: int = 5, size: Span = "1 hour", slide: Span = "5 minutes") -> DataFrame:
    """The most viewed items of every sliding window."""
    return ranking.top_n(item_view_counts(behavior, size, slide), n, ["item_id"]).drop("window_start")


def hot_items_sql(behavior: DataFrame, n: int = 5, size: Span = "1 hour", slide: Span = "5 minutes") -> DataFrame:
    """``hot_items`` written as SQL text over a temporary view."""
    counts = item_view_counts(behavior, size, slide).select("item_id", "cnt", "window_end")
    view = f"item_view_counts_{uuid.uuid4().hex}"
    counts.createOrReplaceTempView(view)
    try:
        return ranking.top_n_sql(behavior.sparkSession, view, n, "item_id")
    finally:
        behavior.sparkSession.catalog.dropTempView(view)


def page_flow(access: DataFrame, n: int = 3, size: Span = "10 minutes", slide: Span = "5 seconds") -> DataFrame:
    """The most read pages of every sliding window (``url, method, ts``)."""
    reads = access.where(F.col("method") == READ_METHOD)
    return ranking.top_n(windows.sliding_counts(reads, "ts", size, slide, ["url"]), n, ["url"]).drop("window_start")


def _late_classified(
    access: DataFrame, seq: str, delay: Span, allowed: Span, size: Span, slide: Span, chunk_rows: int
) -> DataFrame:
    # Every request moves the watermark, also those that are filtered out afterwards.
    classified = lateness.classify_lateness(access, "ts", seq, delay, allowed, size, slide, chunk_rows)
    return classified.where(F.col("method") == READ_METHOD)


def page_flow_with_lateness(
    access: DataFrame,
    seq: str,
    n: int = 3,
    size: Span = "10 minutes",
    slide: Span = "5 seconds",
    delay: Span = "3 seconds",
    allowed: Span = "1 minute",
    chunk_rows: int = 5_000_000,
) -> DataFrame:
    """``page_flow`` where a late request only counts in windows that are still open."""
    reads = _late_classified(access, seq, delay, allowed, size, slide, chunk_rows)
    counts = lateness.sliding_counts_with_lateness(reads, "ts", allowed, size, slide, ["url"])
    return ranking.top_n(counts, n, ["url"]).drop("window_start")


def page_flow_late_rows(
    access: DataFrame,
    seq: str,
    size: Span = "10 minutes",
    slide: Span = "5 seconds",
    delay: Span = "3 seconds",
    allowed: Span = "1 minute",
    chunk_rows: int = 5_000_000,
) -> DataFrame:
    """Requests that arrived too late for every window they belong to."""
    return _late_classified(access, seq, delay, allowed, size, slide, chunk_rows).where("is_late").drop("is_late")


def page_view_totals(behavior: DataFrame, seq: str | None = None, size: Span = "1 hour", salts: int = 64) -> DataFrame:
    """Page views per window; given ``seq``, summed in two salted stages."""
    views = _page_views(behavior)
    if seq is None:
        return windows.tumbling(views, "ts", size).drop("window_start")
    return counting.salted_counts(views, "ts", size, seq, salts=salts).drop("window_start")


_VISITORS = {
    "exact": counting.exact_visitors,
    "hashed": counting.hashed_visitors,
    "approx": counting.approx_visitors,
    "bitmap": counting.bitmap_visitors,
}


def visitors(behavior: DataFrame, method: str = "exact", size: Span = "1 hour") -> DataFrame:
    """Distinct visitors per window: exact, hashed, approx or bitmap."""
    return _VISITORS[method](_page_views(behavior), "ts", size, "user_id").drop("window_start")
