"""Two-stream matching: interval join and one-to-one reconciliation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import Span, floor_div, from_micros, micros, span_us
from tidemark.operators.slices import slice_width, with_halo

PAIRED, LEFT_ONLY, RIGHT_ONLY = "matched", "single_pay", "single_receipt"


def _prefixed(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: Span,
    after: Span,
    bucket: Span | None = None,
) -> DataFrame:
    """Pairs with equal keys and right time in ``[left - before, left + after]``.

    The join key is (keys, time bucket): each left row enters the buckets its
    interval touches, each right row only its own, so a hot key is spread over
    its buckets and compares rows near in time only. Output columns are the
    keys, then ``l_…`` and ``r_…``.
    """
    keys = list(keys)
    before_us, after_us = span_us(before), span_us(after)
    width = span_us(bucket) if bucket is not None else max(before_us + after_us, 1)
    l, r = _bucketed(left, right, keys, left_ts, right_ts, before_us, after_us, width)
    gap = F.col("r__us") - F.col("l__us")
    joined = l.join(r, [*keys, "_bucket"]).where(gap.between(-before_us, after_us))
    return joined.drop("_bucket", "_copies", "l__us", "r__us")


def _bucketed(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    before_us: int,
    after_us: int,
    width: int,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_bucket``; a left row has ``_copies``, one per bucket its interval touches."""
    l = _prefixed(left.withColumn("_us", micros(left, left_ts)), "l_", keys)
    r = _prefixed(right.withColumn("_us", micros(right, right_ts)), "r_", keys)
    first = floor_div(F.col("l__us") - F.lit(before_us), width)
    last = floor_div(F.col("l__us") + F.lit(after_us), width)
    # A row without a time is a copy of its own that no bucket holds.
    l = l.withColumns({"_copies": F.coalesce(last - first + 1, F.lit(1)), "_bucket": F.explode_outer(F.sequence(first, last))})
    return l, r.withColumn("_bucket", floor_div(F.col("r__us"), width))


def interval_outer_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    left_seq: str,
    right_seq: str,
    before: Span,
    after: Span,
    bucket: Span | None = None,
) -> DataFrame:
    """``interval_join`` plus the rows of both sides that meet nobody, told apart by ``outcome``.

    A right row has one bucket, so a full outer join shows at once whether it
    meets anybody. A left row meets nobody if none of its copies does; equal
    left rows, which meet the same rows, keep their number. Rows without a key
    or a time meet nobody.
    """
    keys = list(keys)
    before_us, after_us = span_us(before), span_us(after)
    width = span_us(bucket) if bucket is not None else max(before_us + after_us, 1)
    l, r = _bucketed(left, right, keys, left_ts, right_ts, before_us, after_us, width)
    l_columns = [f"l_{c}" for c in left.columns if c not in keys]
    r_columns = [f"r_{c}" for c in right.columns if c not in keys]
    r = r.withColumn("_is_right", F.lit(True)).withColumnsRenamed({c: f"_right_{c}" for c in [*keys, "_bucket"]})
    near = (F.col("_bucket") == F.col("_right__bucket")) & (F.col("r__us") - F.col("l__us")).between(-before_us, after_us)
    for key in keys:
        near = near & (F.col(key) == F.col(f"_right_{key}"))
    met = l.join(r, near, "full_outer")
    has_left, has_right = F.col("_copies").isNotNull(), F.col("_is_right").isNotNull()
    answered = met.where(has_right).select(
        *[F.when(has_left, F.col(key)).otherwise(F.col(f"_right_{key}")).alias(key) for key in keys],
        *l_columns,
        *r_columns,
        F.when(has_left, PAIRED).otherwise(RIGHT_ONLY).alias("outcome"),
    )
    # Equal rows miss the same buckets, so each bucket missed shows how many they are.
    row = [*keys, "_row"]
    missed = met.where(~has_right).select(*keys, F.struct("_copies", *l_columns).alias("_row"), "_bucket")
    unanswered = (
        missed.groupBy(*row, "_bucket")
        .agg(F.count("*").alias("_equal"))
        .groupBy(*row)
        .agg(F.count("*").alias("_missed"), F.max("_equal").alias("_equal"))
        .where(F.col("_missed") == F.col("_row._copies"))
        .withColumn("_each", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_equal"))))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in l_columns], F.lit(LEFT_ONLY).alias("outcome"))
    )
    return answered.unionByName(unanswered, allowMissingColumns=True)


def _compose(
    first: tuple[np.ndarray, np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shift, low, high = then
    return (
        first[0] + shift,
        np.clip(first[1] + shift, low, high),
        np.clip(first[2] + shift, low, high),
    )


def _running_composition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each row's (_shift, _low, _high) by the composition of its group's rows so far.

    A row stands for ``k -> clip(k + shift, low, high)``; such maps compose to
    maps of the same form. Groups are contiguous and begin where ``_head`` is
    true. Steps double, so a batch takes log2(longest group) vector passes.
    """
    carry: tuple[int, int, int] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        names = batch.schema.names
        at = [names.index(n) for n in ("_shift", "_low", "_high")]
        value = tuple(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in at)
        done = batch.column(names.index("_head")).to_numpy(zero_copy_only=False).astype(bool)
        if carry is not None and not done[0]:
            start = tuple(np.array([c]) for c in carry)
            joined = _compose(start, tuple(v[:1] for v in value))
            for v, j in zip(value, joined):
                v[0] = j[0]
        done = done.copy()
        done[0] = True
        step = 1
        while not done.all():
            rows = np.flatnonzero(~done)
            earlier = rows - step
            composed = _compose(tuple(v[earlier] for v in value), tuple(v[rows] for v in value))
            reached = done[earlier]
            for v, c in zip(value, composed):
                v[rows] = c
            done[rows] = reached
            step *= 2
        carry = tuple(int(v[-1]) for v in value)
        columns = batch.columns
        for i, v in zip(at, value):
            columns[i] = pa.array(v, type=pa.int64())
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _composed(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Running composition per ``group`` along ``order``."""
    spec = Window.partitionBy(*group).orderBy(*order)
    headed = df.withColumn("_head", F.row_number().over(spec) == 1)
    ordered = headed.sortWithinPartitions(*group, *order)
    return ordered.mapInArrow(_running_composition, ordered.schema)


def _clip(value: Column) -> Column:
    return F.greatest(F.least(value, F.col("_high")), F.col("_low"))


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    left_seq: str,
    right_seq: str,
    left_waits: Span,
    right_waits: Span,
    slice: Span | None = None,
) -> DataFrame:
    """One-to-one matching per key, first come first served.

    A left row waits ``left_waits`` for a right row, a right row waits
    ``right_waits`` for a left row; each takes the longest-waiting partner
    still there (left rows first at equal times). Every input row appears once:
    ``outcome`` is matched, single_pay or single_receipt. Rows without a key or
    a time are single.

    At any time only one side waits, so the state of a key is one signed number
    ``k``: the latest ``k`` left rows (or ``-k`` right rows) are waiting. A row
    moves it by one within bounds set by how many rows are still in time, i.e.
    ``k -> clip(k + shift, low, high)``. These maps compose, so the state before
    each time slice comes from one summary row per slice, and no key has to be
    walked from its start in one task.
    """
    keys = list(keys)
    left_wait, right_wait = span_us(left_waits), span_us(right_waits)
    reach = max(left_wait, right_wait)
    width = slice_width(reach, slice)
    kind = left.schema[left_ts].dataType
    rows = left.select(
        *keys, micros(left, left_ts).alias("_us"), F.lit(0).alias("_side"), F.col(left_seq).alias("_seq")
    ).unionByName(
        right.select(
            *keys, micros(right, right_ts).alias("_us"), F.lit(1).alias("_side"), F.col(right_seq).alias("_seq")
        )
    )
    lacking = F.col("_us").isNull()
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    lone = rows.where(lacking)
    rows, full = rows.where(~lacking), keys
    grouped = [*full, "_slice"]
    order = ["_us", "_side", "_seq"]
    by_row = Window.partitionBy(*grouped).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    by_time = Window.partitionBy(*grouped).orderBy("_us")
    is_left = F.col("_side") == 0

    def so_far(side: int, own: bool = False) -> Column:
        counted = F.col("_side") == side
        return F.count(F.when(counted & F.col("_own") if own else counted, 1)).over(by_row)

    def expired(side: int, wait: int) -> Column:
        gone = by_time.rangeBetween(Window.unboundedPreceding, -wait - 1)
        return F.count(F.when(F.col("_side") == side, 1)).over(gone)

    counted = with_halo(rows, "_us", width, back=reach).withColumns(
        {
            "_live_left": so_far(0) - expired(0, left_wait),
            "_live_right": so_far(1) - expired(1, right_wait),
            "_lefts": so_far(0, own=True),
            "_rights": so_far(1, own=True),
        }
    )
    moves = counted.where("_own").select(
        *grouped,
        *order,
        "_lefts",
        "_rights",
        F.when(is_left, 1).otherwise(-1).cast("bigint").alias("_shift"),
        F.when(is_left, 1 - F.col("_live_right")).otherwise(-F.col("_live_right")).alias("_low"),
        F.when(is_left, F.col("_live_left")).otherwise(F.col("_live_left") - 1).alias("_high"),
    )
    # One exchange feeds the summary and the rows, so the composition runs once.
    moved = _composed(moves, grouped, order).drop("_head").repartition(*grouped)

    per_slice = moved.groupBy(*grouped).agg(
        F.max_by(F.struct("_shift", "_low", "_high"), F.struct(*order)).alias("_all"),
        F.max("_lefts").alias("_n_left"),
        F.max("_rights").alias("_n_right"),
    )
    chained = _composed(per_slice.select(*grouped, "_n_left", "_n_right", "_all.*"), full, ["_slice"])
    by_slice = Window.partitionBy(*full).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    entries = chained.select(
        *grouped,
        F.coalesce(F.lag(_clip(F.col("_shift"))).over(by_slice), F.lit(0)).alias("_entry"),
        F.coalesce(F.sum("_n_left").over(earlier), F.lit(0)).alias("_left_before"),
        F.coalesce(F.sum("_n_right").over(earlier), F.lit(0)).alias("_right_before"),
    )
    # A left row that leaves k <= 0 took the longest-waiting right row, and the reverse. Both are
    # filed under the side and rank of the row that waited, so a pair meets in one group of two.
    k = _clip(F.col("_entry") + F.col("_shift"))
    left_rank, right_rank = F.col("_lefts") + F.col("_left_before"), F.col("_rights") + F.col("_right_before")
    took = F.when(is_left & (k <= 0), right_rank + k).when(~is_left & (k >= 0), left_rank - k)
    filed = (
        moved.join(entries, grouped)
        .withColumn("_took", took)
        .select(
            *full,
            *order,
            F.when(F.col("_took").isNull(), F.col("_side")).otherwise(1 - F.col("_side")).alias("_waiter"),
            F.coalesce("_took", F.when(is_left, left_rank).otherwise(right_rank)).alias("_rank"),
        )
    )
    met = filed.groupBy(*full, "_waiter", "_rank").agg(
        F.max(F.when(is_left, F.col("_us"))).alias("_left_us"),
        F.max(F.when(is_left, F.col("_seq"))).alias("pay_seq"),
        F.max(F.when(~is_left, F.col("_us"))).alias("_right_us"),
        F.max(F.when(~is_left, F.col("_seq"))).alias("receipt_seq"),
    )
    outcome = F.when(F.col("_right_us").isNull(), LEFT_ONLY).when(F.col("_left_us").isNull(), RIGHT_ONLY)
    single = lone.select(
        *keys,
        F.when(is_left, F.col("_us")).alias("_left_us"),
        F.when(is_left, F.col("_seq")).alias("pay_seq"),
        F.when(~is_left, F.col("_us")).alias("_right_us"),
        F.when(~is_left, F.col("_seq")).alias("receipt_seq"),
        F.when(is_left, LEFT_ONLY).otherwise(RIGHT_ONLY).alias("outcome"),
    )
    paired = met.select(*keys, "_left_us", "pay_seq", "_right_us", "receipt_seq", outcome.otherwise(PAIRED).alias("outcome"))
    return paired.unionByName(single).select(
        *keys,
        "outcome",
        from_micros(F.col("_left_us"), kind).alias("pay_ts"),
        "pay_seq",
        from_micros(F.col("_right_us"), kind).alias("receipt_ts"),
        "receipt_seq",
    )
