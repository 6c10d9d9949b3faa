"""Ad clicks with a daily cap per user and ad."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.clock import Span
from tidemark.operators.capping import cap_warnings, within_cap
from tidemark.operators.windows import sliding_counts

KEYS = ["user_id", "ad_id"]


def ad_clicks_passed(
    clicks: DataFrame, seq: str, cap: int = 100, utc_offset: Span = "8 hours", piece: Span = "15 minutes"
) -> DataFrame:
    """Clicks up to the cap (``user_id, ad_id, province, ts``)."""
    return within_cap(clicks, KEYS, "ts", seq, cap, utc_offset, piece)


def ad_click_warnings(
    clicks: DataFrame, seq: str, cap: int = 100, utc_offset: Span = "8 hours", piece: Span = "15 minutes"
) -> DataFrame:
    """One warning per user, ad and day over the cap."""
    return cap_warnings(clicks, KEYS, "ts", seq, cap, utc_offset, piece)


def ad_clicks_by_province(
    clicks: DataFrame,
    seq: str,
    cap: int = 100,
    utc_offset: Span = "8 hours",
    size: Span = "1 hour",
    slide: Span = "5 seconds",
    piece: Span = "15 minutes",
) -> DataFrame:
    """Clicks within the cap per province and sliding window."""
    passed = ad_clicks_passed(clicks.select(*KEYS, "province", "ts", seq), seq, cap, utc_offset, piece)
    return sliding_counts(passed, "ts", size, slide, ["province"]).drop("window_start")
