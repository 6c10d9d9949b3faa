"""Routing rows that arrive after the watermark has passed their windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import Span, floor_div, from_micros, micros, span_us
from tidemark.operators.windows import sliding_counts

# Fixed value: a window's last instant lies one millisecond before its end.
LAST_INSTANT_US = 1_000


# Chunks whose summaries share a task of the prefix maximum.
CHUNKS_TOGETHER = 4096


def _with_watermark(df: DataFrame, ts: str, seq: str, delay: Span, chunk_rows: int) -> DataFrame:
    """Add ``_us`` and ``_wm``: greatest event time among earlier arrivals, less ``delay``, in microseconds.

    Arrival order is ``seq``. It is cut into chunks of ``chunk_rows`` sequence
    numbers, so no chunk can hold more rows than that; a chunk starts from the
    greatest time of the chunks before it. That prefix is taken in two levels:
    among chunks that lie together, and among such groups of chunks.
    Rows without a sequence number have no place in the order and no watermark.
    """
    timed = df.withColumn("_us", micros(df, ts))
    rows = timed.where(F.col(seq).isNotNull()).withColumn("_chunk", floor_div(F.col(seq).cast("bigint"), chunk_rows))
    unplaced = timed.where(F.col(seq).isNull()).withColumn("_wm", F.lit(None).cast("bigint"))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_chunk").orderBy(seq).rowsBetween(*earlier)
    chunks = rows.groupBy("_chunk").agg(F.max("_us").alias("_max")).withColumn("_group", floor_div(F.col("_chunk"), CHUNKS_TOGETHER))
    groups = (
        chunks.groupBy("_group")
        .agg(F.max("_max").alias("_group_max"))
        .withColumn("_before_group", F.max("_group_max").over(Window.orderBy("_group").rowsBetween(*earlier)))
        .drop("_group_max")
    )
    together = Window.partitionBy("_group").orderBy("_chunk").rowsBetween(*earlier)
    summary = (
        chunks.withColumn("_in_group", F.max("_max").over(together))
        .join(groups, "_group")
        .select("_chunk", F.greatest("_in_group", "_before_group").alias("_earlier"))
    )
    seen = rows.withColumn("_seen", F.max("_us").over(inside)).join(summary, "_chunk")
    placed = seen.withColumn("_wm", F.greatest("_seen", "_earlier") - F.lit(span_us(delay))).drop("_seen", "_earlier", "_chunk")
    return placed.unionByName(unplaced)


def classify_lateness(
    df: DataFrame,
    ts: str,
    seq: str,
    delay: Span,
    allowed: Span,
    size: Span,
    slide: Span | None = None,
    chunk_rows: int = 5_000_000,
) -> DataFrame:
    """Add ``watermark`` (as each row arrives) and ``is_late``: too late for every window of the row.

    Rows without a time or a sequence number are kept and never late.
    """
    kind = df.schema[ts].dataType
    slide_us = span_us(slide if slide is not None else size)
    last_end = floor_div(F.col("_us"), slide_us) * slide_us + span_us(size)
    closed_at = last_end - LAST_INSTANT_US + span_us(allowed)
    return (
        _with_watermark(df, ts, seq, delay, chunk_rows)
        .withColumn("is_late", F.coalesce(closed_at <= F.col("_wm"), F.lit(False)))
        .withColumn("watermark", from_micros(F.col("_wm"), kind))
        .drop("_us", "_wm")
    )


def sliding_counts_with_lateness(
    classified: DataFrame,
    ts: str,
    allowed: Span,
    size: Span,
    slide: Span,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Final sliding counts when a row only enters the windows still open as it arrives.

    Takes the output of ``classify_lateness``, possibly filtered.
    """
    wm = micros(classified, "watermark")
    slide_us = span_us(slide)
    first_open = floor_div(wm + LAST_INSTANT_US - span_us(allowed) - span_us(size), slide_us) + 1
    return sliding_counts(classified, ts, size, slide, keys, first_open=first_open)
