"""Daily cap on how often a key may act, with one warning per key and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import Span, floor_div, local_day, micros, span_us
from tidemark.operators.slices import NULLS, hide_nulls, running_rank, show_nulls

PASS, WARN, DROP = "pass", "warn", "drop"


def _with_day(df: DataFrame, ts: str, utc_offset: Span) -> DataFrame:
    return df.withColumn("day", local_day(df, ts, utc_offset))


def cap_outcomes(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    cap: int,
    utc_offset: Span = "8 hours",
    piece: Span = "15 minutes",
) -> DataFrame:
    """Every row with ``day``, its ``day_rank`` and ``outcome``: pass, warn (the first over the cap) or drop."""
    sliced = _with_day(df, ts, utc_offset).withColumn("_piece", floor_div(micros(df, ts), span_us(piece)))
    ranked = running_rank(sliced, [*keys, "day"], "_piece", [ts, seq], name="day_rank").drop("_piece")
    return ranked.withColumn("outcome", cap_outcome(F.col("day_rank"), cap))


def cap_outcome(rank: Column, cap: int) -> Column:
    return F.when(rank <= cap, PASS).when(rank == cap + 1, WARN).otherwise(DROP)


def _ranked_head(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, limit: int, utc_offset: Span, piece: Span
) -> DataFrame:
    """The first ``limit`` rows per key and day with their ``day_rank``.

    No more than ``limit`` rows of a piece of the day can be among them, which Spark cuts in the map tasks; the counts
    of the earlier pieces, taken before that cut, turn ranks of the piece into ranks of the day.
    """
    dated = _with_day(df, ts, utc_offset).withColumn("_piece", floor_div(micros(df, ts), span_us(piece)))
    rows, day = hide_nulls(dated, [*keys, "day", "_piece"])
    order = Window.partitionBy(*day).orderBy(ts, seq)
    heads = rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)
    # Rows without a time are a day of their own, so pieces need no order among nulls.
    before = Window.partitionBy(*keys, "day", NULLS).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*day).agg(F.count("*").alias("_n"))
    offsets = counts.select(*day, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < limit)
    ranked = heads.join(offsets, day).withColumn("day_rank", (F.col("_rank") + F.col("_before")).cast("int"))
    return show_nulls(ranked.where(F.col("day_rank") <= limit), [*keys, "day", "_piece"]).select(*df.columns, "day", "day_rank")


def within_cap(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    cap: int,
    utc_offset: Span = "8 hours",
    piece: Span = "15 minutes",
) -> DataFrame:
    """The first ``cap`` rows per key and day."""
    return _ranked_head(df, keys, ts, seq, cap, utc_offset, piece).drop("day_rank")


def cap_warnings(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    cap: int,
    utc_offset: Span = "8 hours",
    piece: Span = "15 minutes",
) -> DataFrame:
    """One row per key and day that went over the cap: when, and by which event."""
    head = _ranked_head(df, keys, ts, seq, cap + 1, utc_offset, piece)
    return head.where(F.col("day_rank") == cap + 1).select(
        *keys,
        "day",
        F.lit(cap).alias("cap"),
        F.col(ts).alias("first_over_ts"),
        F.col(seq).alias("first_over_seq"),
        F.format_string(f"more than {cap} times on %s", F.col("day").cast("string")).alias("message"),
    )
