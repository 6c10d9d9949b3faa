"""Ready-made analyses over the event kinds of ``tidemark.schemas``.

Each takes a frame with the documented columns plus ``ts`` and a sequence
column, and returns a frame. Defaults are the usual production settings; pass
other durations for sparser data.
"""

from tidemark.plans.ads import ad_clicks_by_province, ad_clicks_passed, ad_click_warnings
from tidemark.plans.logins import failed_bursts, failed_pairs, failed_triples
from tidemark.plans.marketing import channel_behavior_counts
from tidemark.plans.orders import order_outcomes, order_payments, payments_with_receipts, reconciled_payments
from tidemark.plans.traffic import (
    hot_items,
    hot_items_sql,
    item_view_counts,
    page_flow,
    page_flow_late_rows,
    page_flow_with_lateness,
    page_view_totals,
    visitors,
)

__all__ = [
    "ad_click_warnings",
    "ad_clicks_by_province",
    "ad_clicks_passed",
    "channel_behavior_counts",
    "failed_bursts",
    "failed_pairs",
    "failed_triples",
    "hot_items",
    "hot_items_sql",
    "item_view_counts",
    "order_outcomes",
    "order_payments",
    "page_flow",
    "page_flow_late_rows",
    "page_flow_with_lateness",
    "page_view_totals",
    "payments_with_receipts",
    "reconciled_payments",
    "visitors",
]
