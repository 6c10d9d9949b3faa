"""Splitting one key's timeline into slices that run in parallel.

An ordered operator that partitions by key alone sends every row of a hot key
to one task. The helpers here partition by (key, time slice) instead and make
the slices agree in one of three exact ways:

* ``with_halo``    copies the rows near a slice border into the neighbour, for
  operators that only look a bounded time back or ahead;
* ``running_rank`` adds what earlier slices contribute, taken from one summary
  row per (key, slice);
* ``neighbours``   resolves the first and last row of each slice in a second,
  small window.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import Span, floor_div, micros, span_us

DAY_US = 86_400_000_000


def slice_width(look_us: int, width: Span | None, spans: int = 16) -> int:
    """Slice width in microseconds, if not given by ``width``.

    ``spans`` times the time an operator looks around keeps halo copies rare;
    at most a day keeps a hot key's slices many; at least twice the time looked
    around keeps the copies below half of the rows.
    """
    if width is not None:
        return span_us(width)
    look_us = max(look_us, 1)
    return max(2 * look_us, min(spans * look_us, DAY_US))


def fitting_width(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    widest: Span,
    narrowest: Span = "1 millisecond",
    max_rows: int = 20_000_000,
) -> timedelta:
    """Measure how wide slices may be for no (key, slice) to hold more than ``max_rows`` rows.

    Pass the result as ``slice=``, ``piece=`` or ``bucket=``. Each look is one
    scan of keys and time that counts in the map tasks and returns one number;
    the width shrinks by the factor it was exceeded, until it fits or is
    ``narrowest``. With a halo, a width below the time looked around copies
    every row into several slices, so ``narrowest`` is best set to that time.
    """
    width, floor = span_us(widest), max(1, span_us(narrowest))
    rows = df.select(*keys, micros(df, ts).alias("_us"))
    while width > floor:
        counts = rows.groupBy(*keys, floor_div(F.col("_us"), width).alias("_slice")).agg(F.count("*").alias("_n"))
        largest = counts.agg(F.max("_n")).first()[0] or 0
        if largest <= max_rows:
            break
        width = max(floor, width // -(-largest // max_rows))
    return timedelta(microseconds=width)


def with_halo(df: DataFrame, us: str, width: int, back: int = 0, ahead: int = 0) -> DataFrame:
    """Add ``_slice`` and ``_own``; rows within reach of another slice appear there too.

    Slice ``s`` holds its own rows (``_own``) and every row up to ``back``
    microseconds before or ``ahead`` microseconds after them.
    """
    reach = F.sequence(floor_div(F.col(us) - F.lit(ahead), width), floor_div(F.col(us) + F.lit(back), width))
    return (
        df.withColumn("_slice", F.explode(reach))
        .withColumn("_own", F.col("_slice") == floor_div(F.col(us), width))
    )


NULLS = "_nulls"


def hide_nulls(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Replace null keys by a plain value plus a mark, and return the frame and its full key.

    Windows group null keys but joins drop them; with plain values both work on
    the same hash partitioning, so a join after a window needs no further shuffle.
    """
    flags = F.lit(0)
    plain = {}
    for bit, key in enumerate(keys):
        flags = flags + F.when(F.col(key).isNull(), 1 << bit).otherwise(0)
        plain[key] = F.coalesce(F.col(key), _plain_value(df.schema[key].dataType))
    return df.withColumns({NULLS: flags, **plain}), [*keys, NULLS]


def show_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Undo ``hide_nulls``."""
    shown = {
        key: F.when(F.col(NULLS).bitwiseAND(1 << bit) == 0, F.col(key)) for bit, key in enumerate(keys)
    }
    return df.withColumns(shown).drop(NULLS)


def _plain_value(kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.BinaryType):
        return F.lit(bytearray())
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    raise TypeError(f"unsupported key type: {kind.simpleString()}")


def running_rank(
    df: DataFrame, keys: Sequence[str], slice_col: str, order: Sequence[str], name: str = "rank"
) -> DataFrame:
    """``row_number`` per key over ``order`` without one task per key.

    ``slice_col`` must not decrease along ``order``. The rank inside a slice is
    raised by the row count of the key's earlier slices.
    """
    rows, key = hide_nulls(df, keys)
    # Rows without a time come first, as in any ascending order.
    rows = rows.withColumn("_piece_no", F.coalesce(F.col(slice_col), F.lit(-(1 << 62))))
    full = [*key, "_piece_no"]
    before = Window.partitionBy(*key).orderBy("_piece_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*full)
        .agg(F.count("*").alias("_n"))
        .select(*full, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*full).orderBy(*order)))
    ranked = inside.join(offsets, full).withColumn(name, (F.col("_rank") + F.col("_before")).cast("bigint"))
    return show_nulls(ranked, keys).select(*df.columns, name)


def neighbours(
    df: DataFrame, keys: Sequence[str], slice_col: str, order: Sequence[str], payload: Column
) -> DataFrame:
    """Add ``_prev`` and ``_next``: ``payload`` of the rows just before and after, per key.

    Rows inside a slice get both from one window per (key, slice). Only the
    first and last row of each slice go on to a window per key, so that window
    sees two rows per slice, however many rows the key has.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, slice_col).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(*order)
    rows = (
        df.withColumn("_payload", payload)
        .withColumn("_prev", F.lag("_payload").over(inside))
        .withColumn("_next", F.lead("_payload").over(inside))
    )
    at_edge = F.col("_prev").isNull() | F.col("_next").isNull()
    edges = (
        rows.where(at_edge)
        .withColumn("_prev", F.coalesce("_prev", F.lag("_payload").over(across)))
        .withColumn("_next", F.coalesce("_next", F.lead("_payload").over(across)))
    )
    return rows.where(~at_edge).unionByName(edges).drop("_payload")
