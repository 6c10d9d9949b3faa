from tidemark.functions.clock import floor_div, from_micros, local_day, micros, span_us
from tidemark.functions.scalars import (
    access_log_time,
    choice,
    epoch_millis,
    epoch_seconds,
    message,
    poly_hash,
)

__all__ = [
    "access_log_time",
    "choice",
    "epoch_millis",
    "epoch_seconds",
    "floor_div",
    "from_micros",
    "local_day",
    "message",
    "micros",
    "poly_hash",
    "span_us",
]
