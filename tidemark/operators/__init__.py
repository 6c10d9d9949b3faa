from tidemark.operators.bursts import failure_bursts
from tidemark.operators.capping import cap_outcomes, cap_warnings, within_cap
from tidemark.operators.counting import (
    approx_visitors,
    bitmap_visitors,
    exact_visitors,
    hashed_visitors,
    running_visitors,
    salted_counts,
)
from tidemark.operators.custom import Aggregate, custom_aggregate, custom_sliding
from tidemark.operators.lateness import classify_lateness, sliding_counts_with_lateness
from tidemark.operators.pairing import interval_join, interval_outer_join, reconcile
from tidemark.operators.ranking import ranking_report, top_n, top_n_sql
from tidemark.operators.sequences import (
    Pattern,
    adjacent_pairs_by_arrival,
    consecutive_hits,
    match,
    open_close_outcomes,
)
from tidemark.operators.slices import fitting_width
from tidemark.operators.windows import (
    pane_values,
    sliding_aggregate,
    sliding_counts,
    sliding_direct,
    sliding_merge,
    tumbling,
    windows_of_panes,
)

__all__ = [
    "Aggregate",
    "Pattern",
    "adjacent_pairs_by_arrival",
    "approx_visitors",
    "bitmap_visitors",
    "cap_outcomes",
    "cap_warnings",
    "classify_lateness",
    "consecutive_hits",
    "custom_aggregate",
    "custom_sliding",
    "exact_visitors",
    "failure_bursts",
    "fitting_width",
    "hashed_visitors",
    "interval_join",
    "interval_outer_join",
    "match",
    "open_close_outcomes",
    "ranking_report",
    "reconcile",
    "running_visitors",
    "salted_counts",
    "pane_values",
    "sliding_aggregate",
    "sliding_counts",
    "sliding_counts_with_lateness",
    "sliding_direct",
    "sliding_merge",
    "windows_of_panes",
    "top_n",
    "top_n_sql",
    "tumbling",
    "within_cap",
]
