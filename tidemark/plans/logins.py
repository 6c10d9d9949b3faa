"""Repeated failed logins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import Span
from tidemark.operators.bursts import failure_bursts
from tidemark.operators.sequences import adjacent_pairs_by_arrival, consecutive_hits

FAILED = "fail"


def failed_pairs(logins: DataFrame, seq: str, within: Span = "2 seconds", by_arrival: bool = False, slice: Span | None = None) -> DataFrame:
    """Two failures in a row at most ``within`` apart (``user_id, event_type, ts``)."""
    failed = F.col("event_type") == FAILED
    if by_arrival:
        return adjacent_pairs_by_arrival(logins, ["user_id"], "ts", seq, failed, within)
    return consecutive_hits(logins, ["user_id"], "ts", seq, failed, 2, within, inclusive=True, slice=slice)


def failed_triples(logins: DataFrame, seq: str, n: int = 3, within: Span = "5 seconds", slice: Span | None = None) -> DataFrame:
    """``n`` failures in a row in less than ``within``."""
    return consecutive_hits(logins, ["user_id"], "ts", seq, F.col("event_type") == FAILED, n, within, slice=slice)


def failed_bursts(logins: DataFrame, seq: str, n: int = 3, within: Span = "5 seconds") -> DataFrame:
    """At least ``n`` failures before the deadline set by the first, with no success in between."""
    return failure_bursts(logins, ["user_id"], "ts", seq, F.col("event_type") == FAILED, within, n)
