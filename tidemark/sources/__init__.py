from tidemark.sources.access_log import parse_access_log, read_access_log
from tidemark.sources.delimited import parse_lines, read_events
from tidemark.sources.lines import lines_source, publish, replay_events

__all__ = [
    "lines_source",
    "parse_access_log",
    "parse_lines",
    "publish",
    "read_access_log",
    "read_events",
    "replay_events",
]
