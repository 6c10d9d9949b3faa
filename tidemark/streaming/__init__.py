from tidemark.streaming.corrected import stream_counts_corrected
from tidemark.streaming.ranking import stream_best_rows
from tidemark.streaming.sinks import (
    changelog_sink,
    changes,
    console_sink,
    corrected_ranked_sink,
    latest,
    memory_sink,
    net,
    ranked_sink,
    retract_sink,
    retractions,
    route_late,
    routed_sink,
    upsert_sink,
    upserted,
)
from tidemark.streaming.stateful import (
    stream_cap_outcomes,
    stream_failure_bursts,
    stream_followed_by,
    stream_match,
    stream_open_close_outcomes,
    stream_reconcile,
    stream_running_visitors,
)
from tidemark.streaming.wall_clock import stream_cap_by_clock
from tidemark.streaming.windows import event_time, stream_counts, stream_interval_join, stream_visitors

__all__ = [
    "changelog_sink",
    "changes",
    "console_sink",
    "corrected_ranked_sink",
    "event_time",
    "latest",
    "memory_sink",
    "net",
    "ranked_sink",
    "retract_sink",
    "retractions",
    "route_late",
    "routed_sink",
    "stream_best_rows",
    "stream_cap_by_clock",
    "stream_cap_outcomes",
    "stream_counts",
    "stream_counts_corrected",
    "stream_failure_bursts",
    "stream_followed_by",
    "stream_interval_join",
    "stream_match",
    "stream_open_close_outcomes",
    "stream_reconcile",
    "stream_running_visitors",
    "stream_visitors",
    "upsert_sink",
    "upserted",
]
