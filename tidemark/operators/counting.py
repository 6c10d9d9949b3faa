"""Totals and distinct-visitor counts per tumbling window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import Span, floor_div, micros, span_us
from tidemark.functions.scalars import poly_hash
from tidemark.operators.slices import running_rank
from tidemark.operators.windows import tumbling


def salted_counts(
    df: DataFrame, ts: str, size: Span, seq: str, keys: Sequence[str] = (), salts: int = 64
) -> DataFrame:
    """Window counts in two stages: per key and salt, then summed per key.

    Partial aggregation already protects plain counts; this form also spreads
    the final merge of one hot key over ``salts`` tasks.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(seq), F.lit(salts)).cast("int"))
    partial = tumbling(salted, ts, size, [*keys, "_salt"])
    return partial.groupBy(*keys, "window_start", "window_end").agg(F.sum("cnt").alias("cnt"))


def exact_visitors(df: DataFrame, ts: str, size: Span, user: str) -> DataFrame:
    """Distinct users per window. Spark groups by (window, user) first, so no task holds a whole window."""
    return tumbling(df, ts, size, aggregates=[F.count_distinct(F.col(user)).alias("cnt")])


def hashed_visitors(df: DataFrame, ts: str, size: Span, user: str) -> DataFrame:
    """Distinct slots of a 2^29-bit hashed bitmap per window; collisions undercount."""
    return tumbling(df, ts, size, aggregates=[F.count_distinct(poly_hash(user)).alias("cnt")])


def approx_visitors(df: DataFrame, ts: str, size: Span, user: str, rsd: float = 0.02) -> DataFrame:
    """HyperLogLog++ estimate per window with relative error about ``rsd``."""
    return tumbling(df, ts, size, aggregates=[F.approx_count_distinct(user, rsd).alias("cnt")])


def bitmap_visitors(df: DataFrame, ts: str, size: Span, user: str) -> DataFrame:
    """Exact distinct non-negative integer ids per window from mergeable bitmaps.

    For dense ids: a bitmap of 4 KiB stands for 32,768 neighbouring ids, so sparse ids are better counted by
    ``exact_visitors``. Windows in which no row names a user count 0.
    """
    bucketed = df.withColumn("_bucket", F.bitmap_bucket_number(user))
    blocks = tumbling(
        bucketed, ts, size, ["_bucket"], [F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("_bits")]
    )
    return blocks.groupBy("window_start", "window_end").agg(F.sum(F.coalesce(F.bitmap_count("_bits"), F.lit(0))).alias("cnt"))


def running_visitors(
    df: DataFrame, ts: str, seq: str, size: Span, user: Column | str, pieces: int = 64
) -> DataFrame:
    """A row for each user's first event in a window, with the distinct count so far.

    Ranks are taken inside ``pieces`` time pieces of the window and raised by
    the counts of the earlier pieces, so one busy window is not one task.
    """
    size_us = span_us(size)
    piece = max(1, size_us // pieces)
    kind = df.schema[ts].dataType
    rows = df.select(
        F.window(ts, f"{size_us} microseconds").alias("_w"),
        (F.col(user) if isinstance(user, str) else user).alias("visitor"),
        ts,
        seq,
    )
    first = (
        rows.groupBy("_w", "visitor")
        .agg(F.min(F.struct(ts, seq)).alias("_first"))
        .select(
            F.col("_w.end").cast(kind).alias("window_end"),
            "visitor",
            F.col(f"_first.{ts}").alias(ts),
            F.col(f"_first.{seq}").alias(seq),
        )
    )
    sliced = first.withColumn("_piece", floor_div(micros(first, ts), piece))
    ranked = running_rank(sliced, ["window_end"], "_piece", [ts, seq], name="cnt")
    return ranked.select("window_end", "visitor", ts, seq, "cnt")
