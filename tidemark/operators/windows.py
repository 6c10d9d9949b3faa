"""Tumbling and sliding event-time windows, ``[start, end)`` and epoch aligned."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import Span, floor_div, from_micros, micros, span_us

COUNT = "cnt"
PANE = "_pane"


def tumbling(
    df: DataFrame,
    ts: str,
    size: Span,
    keys: Sequence[str] = (),
    aggregates: Sequence[Column] | None = None,
) -> DataFrame:
    """Aggregate per key and tumbling window; without keys, per window only.

    Map tasks combine first, so neither a hot key nor a single key-less window
    funnels raw rows into one task.
    """
    aggregates = aggregates or [F.count("*").alias(COUNT)]
    grouped = df.groupBy(*keys, F.window(ts, f"{span_us(size)} microseconds").alias("_w")).agg(*aggregates)
    results = [c for c in grouped.columns if c not in (*keys, "_w")]
    return grouped.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *results
    )


def sliding_direct(
    df: DataFrame,
    ts: str,
    size: Span,
    slide: Span,
    keys: Sequence[str] = (),
    aggregates: Sequence[Column] | None = None,
) -> DataFrame:
    """Sliding windows through ``window()``: every row is copied once per window.

    Takes any aggregate; meant for few overlaps. Counts over many overlaps
    belong in ``sliding_counts``.
    """
    aggregates = aggregates or [F.count("*").alias(COUNT)]
    spec = F.window(ts, f"{span_us(size)} microseconds", f"{span_us(slide)} microseconds").alias("_w")
    grouped = df.groupBy(*keys, spec).agg(*aggregates)
    results = [c for c in grouped.columns if c not in (*keys, "_w")]
    return grouped.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *results
    )


def _parallelism(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _window_range(us: Column, size_us: int, slide_us: int) -> tuple[Column, Column]:
    """First and last index of the windows holding ``us``; window ``i`` starts at ``i * slide``."""
    return floor_div(us - F.lit(size_us), slide_us) + 1, floor_div(us, slide_us)


def sliding_counts(
    df: DataFrame,
    ts: str,
    size: Span,
    slide: Span,
    keys: Sequence[str] = (),
    first_open: Column | None = None,
    windows_per_slice: int | None = None,
) -> DataFrame:
    """Row count per key and sliding window, at a cost independent of the overlap.

    1. Count rows per key and pane (the rows that share all their windows);
       map tasks combine, so a hot key shrinks to its panes before the shuffle.
    2. A pane raises the count at its first window and lowers it after its last.
    3. A running sum over these changes gives the count at every window, and
       one ``sequence`` writes the windows between two changes.

    The sum runs per key and time slice; a pane that spans two slices is
    entered in both, so the slices are independent. ``first_open`` optionally
    gives, per row, the earliest window index that still accepts it.
    """
    keys = list(keys)
    size_us, slide_us = span_us(size), span_us(slide)
    kind = df.schema[ts].dataType
    per_slice = windows_per_slice or max(1024, 4 * -(-size_us // slide_us))
    first, last = _window_range(micros(df, ts), size_us, slide_us)
    if first_open is not None:
        first = F.greatest(first, first_open)
    panes = (
        df.select(*keys, first.alias("_first"), last.alias("_last"))
        .where(F.col("_first") <= F.col("_last"))
        .groupBy(*keys, "_first", "_last")
        .agg(F.count("*").alias("_n"))
    )

    def changes(slice_no: Column) -> Column:
        start, end = slice_no * per_slice, (slice_no + 1) * per_slice
        return F.array(
            F.struct(
                slice_no.alias("_slice"), F.greatest("_first", start).alias("_i"), F.col("_n").alias("_change")
            ),
            F.struct(
                slice_no.alias("_slice"),
                F.least(F.col("_last") + 1, end).alias("_i"),
                (-F.col("_n")).alias("_change"),
            ),
        )

    spanned = F.sequence(floor_div(F.col("_first"), per_slice), floor_div(F.col("_last"), per_slice))
    moves = panes.select(*keys, F.inline(F.flatten(F.transform(spanned, changes))))
    # The few changes grow into many windows below, so keep the full parallelism here: a
    # given partition count is not coalesced by the size of the changes.
    moves = moves.repartition(_parallelism(df), *keys, "_slice")
    in_slice = Window.partitionBy(*keys, "_slice").orderBy("_i")
    steps = moves.select(
        *keys,
        "_i",
        F.sum("_change").over(in_slice.rowsBetween(Window.unboundedPreceding, 0)).alias(COUNT),
        F.lead("_i").over(in_slice).alias("_until"),
    ).where((F.col("_until") > F.col("_i")) & (F.col(COUNT) > 0))
    windows = steps.select(*keys, COUNT, F.explode(F.sequence("_i", F.col("_until") - 1)).alias("_i"))
    return windows.select(
        *keys,
        from_micros(F.col("_i") * slide_us, kind).alias("window_start"),
        from_micros(F.col("_i") * slide_us + size_us, kind).alias("window_end"),
        COUNT,
    )


def sliding_merge(
    df: DataFrame,
    ts: str,
    size: Span,
    slide: Span,
    keys: Sequence[str],
    partials: Sequence[Column],
    merges: Sequence[Column],
) -> DataFrame:
    """Sliding windows for any mergeable aggregate (min, max, sum, sketches).

    ``partials`` aggregate rows into panes; ``merges`` combine the panes of a
    window and may use the partial columns. Only panes are copied per window.
    """
    keys = list(keys)
    size_us, slide_us = span_us(size), span_us(slide)
    kind = df.schema[ts].dataType
    first, last = _window_range(micros(df, ts), size_us, slide_us)
    panes = df.withColumns({"_first": first, "_last": last}).groupBy(*keys, "_first", "_last").agg(*partials)
    spread = panes.withColumn("_i", F.explode(F.sequence("_first", "_last"))).where(F.col("_first") <= F.col("_last"))
    merged = spread.groupBy(*keys, "_i").agg(*merges)
    results = [c for c in merged.columns if c not in (*keys, "_i")]
    return merged.select(
        *keys,
        from_micros(F.col("_i") * slide_us, kind).alias("window_start"),
        from_micros(F.col("_i") * slide_us + size_us, kind).alias("window_end"),
        *results,
    )


def pane_values(
    df: DataFrame, ts: str, size: Span, slide: Span, keys: Sequence[str], partials: Mapping[str, Column]
) -> DataFrame:
    """``partials`` per key and pane: the stretches of which every window of ``size`` and ``slide`` is made up.

    The frame can be written and read again: ``windows_of_panes`` turns it, or the union of several, into windows. Rows
    without a time belong to no pane.
    """
    pane = floor_div(micros(df, ts), gcd(span_us(size), span_us(slide)))
    timed = df.withColumn(PANE, pane).where(F.col(PANE).isNotNull())
    return timed.groupBy(*keys, PANE).agg(*[value.alias(name) for name, value in partials.items()])


def windows_of_panes(
    panes: DataFrame,
    size: Span,
    slide: Span,
    keys: Sequence[str],
    merges: Mapping[str, Callable[[str], Column]],
    like: T.DataType | None = None,
) -> DataFrame:
    """Sliding windows from ``pane_values`` at two merges a window, whatever the overlap.

    ``merges`` names for each value the aggregate that combines it (``F.min``, ``F.hll_union_agg``); it need not be one
    that can be taken back. Panes are cut into blocks as long as a window. A window is the end of one block and the
    beginning of the next, so the running merges of each block, backwards and forwards, give every window as two values.
    Windows per (key, block) are of at most one block of panes. Several rows of a pane are merged. Times have type ``like``
    (zone-less if not given).
    """
    keys = list(keys)
    size_us, slide_us = span_us(size), span_us(slide)
    pane_us = gcd(size_us, slide_us)
    wide, step = size_us // pane_us, slide_us // pane_us
    names = list(merges)
    single = panes.groupBy(*keys, PANE).agg(*[merge(name).alias(name) for name, merge in merges.items()])
    start = floor_div(F.col(PANE), wide) * wide
    blocks = single.withColumn("_start", start)
    by = Window.partitionBy(*keys, "_start")
    forwards = by.orderBy(PANE)
    toward, back = (w.rowsBetween(Window.unboundedPreceding, 0) for w in (forwards, by.orderBy(F.desc(PANE))))
    blocks = blocks.withColumns(
        {f"_ahead{i}": merges[name](name).over(back) for i, name in enumerate(names)}
        | {f"_behind{i}": merges[name](name).over(toward) for i, name in enumerate(names)}
        | {"_earlier": F.lag(PANE).over(forwards), "_later": F.lead(PANE).over(forwards)}
    )
    # The merge from a pane to its block's end serves the windows that begin at it or in the empty panes before it. The merge
    # from a block's start to a pane serves those that end there or before the next pane, but for the block itself.
    ending = F.struct(
        F.coalesce(F.col("_earlier") + 1, F.col("_start")).alias("_low"), F.col(PANE).alias("_high"),
        *[F.col(f"_ahead{i}").alias(name) for i, name in enumerate(names)],
    )
    beginning = F.struct(
        (F.col(PANE) - wide + 1).alias("_low"),
        (F.least(F.coalesce(F.col("_later") - 1, F.col("_start") + wide), F.col("_start") + (wide - 2)) - wide + 1).alias("_high"),
        *[F.col(f"_behind{i}").alias(name) for i, name in enumerate(names)],
    )
    halves = blocks.select(*keys, F.inline(F.array(ending, beginning))).where("_low <= _high")
    first = -floor_div(-F.col("_low"), step)
    served = halves.withColumns({"_first": first, "_last": floor_div(F.col("_high"), step)}).where("_first <= _last")
    windows = served.select(*keys, *names, F.explode(F.sequence("_first", "_last")).alias("_i"))
    merged = windows.groupBy(*keys, "_i").agg(*[merge(name).alias(name) for name, merge in merges.items()])
    kind = like or T.TimestampNTZType()
    return merged.select(
        *keys,
        from_micros(F.col("_i") * slide_us, kind).alias("window_start"),
        from_micros(F.col("_i") * slide_us + size_us, kind).alias("window_end"),
        *names,
    )


def sliding_aggregate(
    df: DataFrame,
    ts: str,
    size: Span,
    slide: Span,
    keys: Sequence[str],
    partials: Mapping[str, Column],
    merges: Mapping[str, Callable[[str], Column]],
) -> DataFrame:
    """``windows_of_panes`` of ``pane_values``: any mergeable aggregate over sliding windows at a fixed cost a window."""
    panes = pane_values(df, ts, size, slide, keys, partials)
    return windows_of_panes(panes, size, slide, keys, merges, df.schema[ts].dataType)
