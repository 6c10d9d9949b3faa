"""Windows and joins over streams, in append mode."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import Span, micros, span_us


def _text(us: int) -> str:
    return f"{us} microseconds"


def event_time(stream: DataFrame, ts: str, delay: Span = "1 millisecond") -> DataFrame:
    """Declare ``ts`` as event time with a watermark ``delay`` behind the latest row.

    Spark takes rows at the watermark itself for late. A delay of one
    millisecond therefore suits ascending times that may repeat. A zone-less
    ``ts`` is read as UTC.
    """
    return stream.withColumn(ts, F.timestamp_micros(micros(stream, ts))).withWatermark(ts, _text(span_us(delay)))


def stream_counts(
    stream: DataFrame,
    ts: str,
    size: Span,
    slide: Span | None = None,
    keys: Sequence[str] = (),
    delay: Span = "1 millisecond",
) -> DataFrame:
    """Row count per key and tumbling or sliding window, emitted once the watermark passes its end.

    Sliding windows are merged from panes, so the state holds one row per pane
    instead of one per row and window. To count rows that are late by an
    allowed time, add that time to ``delay``.
    """
    keys = list(keys)
    timed = event_time(stream, ts, delay)
    size_us = span_us(size)
    slide_us = span_us(slide) if slide is not None else size_us
    pane_us = gcd(size_us, slide_us)
    panes = timed.groupBy(*keys, F.window(ts, _text(pane_us)).alias("_p")).agg(F.count("*").alias("cnt"))
    if pane_us == size_us == slide_us:
        windows = panes.withColumnRenamed("_p", "_w")
    else:
        spec = F.window(F.window_time("_p"), _text(size_us), _text(slide_us)).alias("_w")
        windows = panes.groupBy(*keys, spec).agg(F.sum("cnt").alias("cnt"))
    return windows.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "cnt")


def stream_visitors(
    stream: DataFrame, ts: str, size: Span, user: str, delay: Span = "1 millisecond"
) -> DataFrame:
    """Exact distinct users per tumbling window: one state row per (window, user), then a count."""
    seen = event_time(stream, ts, delay).groupBy(F.window(ts, _text(span_us(size))).alias("_u"), user).agg(
        F.count("*").alias("_n")
    )
    counted = seen.groupBy(F.window(F.window_time("_u"), _text(span_us(size))).alias("_w")).agg(
        F.count("*").alias("cnt")
    )
    return counted.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "cnt")


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: Span,
    after: Span,
    how: str = "inner",
    delay: Span = "1 millisecond",
) -> DataFrame:
    """``interval_join`` of two streams; ``how="fullOuter"`` also emits the rows that meet nobody.

    Spark derives from the bounds how long each side must be kept.
    """
    l = event_time(left, left_ts, delay)
    l = l.select(*[F.col(c).alias(f"l_{c}") for c in l.columns])
    r = event_time(right, right_ts, delay)
    r = r.select(*[F.col(c).alias(f"r_{c}") for c in r.columns])
    condition = (F.col(f"r_{right_ts}") >= F.col(f"l_{left_ts}") - F.expr(f"interval {span_us(before)} microseconds")) & (
        F.col(f"r_{right_ts}") <= F.col(f"l_{left_ts}") + F.expr(f"interval {span_us(after)} microseconds")
    )
    for key in keys:
        condition = condition & (F.col(f"l_{key}") == F.col(f"r_{key}"))
    return l.join(r, condition, how)
