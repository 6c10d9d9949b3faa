"""Bursts of failures opened by a first failure and closed by a deadline.

The first failure of a key opens a burst that ends ``within`` later. A success
before the deadline cancels it. Otherwise an alarm is raised if the burst holds
enough failures, and the next failure opens a new burst.

Whether a failure opens a burst depends on the burst before it, but only while
failures follow each other by at most ``within`` without a success. A failure
after a longer pause, or after a success, always opens one (a *root*).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import Span, floor_div, from_micros, micros, span_us
from tidemark.operators.slices import hide_nulls, show_nulls, slice_width, with_halo

_NEVER = -(1 << 62)
SLICE_SPANS = 64  # default slice width, in burst lengths
HALO_SPANS = 4  # how far before its slice a run may begin without being chained, in burst lengths …
SLICES_PER_BLOCK = 256
HALO_PART = 8  # … and at most this part of the slice


def failure_bursts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    failed: Column,
    within: Span,
    min_failures: int,
    slice: Span | None = None,
) -> DataFrame:
    """Bursts of at least ``min_failures`` failures in ``[first, first + within]`` without a success.

    Columns: keys, ``first_ts``, ``first_seq``, ``last_ts``, ``n_fails``.

    Counts and roots come from windows per (key, time slice) with a halo. Which
    other failures open a burst is then followed from root to root inside each
    slice. Only a run of failures that began long before a slice needs the
    state that slice starts from; for such slices a small table "state in,
    state out" is built in parallel and chained per key.
    """
    keys = list(keys)
    span = span_us(within)
    width = slice_width(span, slice, SLICE_SPANS)
    if width < span:
        raise ValueError("a slice must not be shorter than a burst")
    kind = df.schema[ts].dataType
    rows = df.select(
        *keys, micros(df, ts).alias("_us"), F.col(seq).alias("_seq"), F.coalesce(failed, F.lit(False)).alias("_fail")
    )
    rows, full = hide_nulls(rows, keys)
    grouped = [*full, "_slice"]
    fails = _rooted_failures(rows, grouped, span, width, min_failures)

    tables = (
        fails.where("_chained")
        .select(*grouped, "_us", "_seq", "_root")
        .groupBy(*grouped)
        .applyInArrow(_transfer_table(span), _schema(fails, grouped, "_until array<bigint>, _out array<bigint>"))
    )
    # Blocks of slices are composed in parallel, chained per key by one table each, and then
    # resolved slice by slice, again in parallel.
    per_block = [*full, "_block"]
    tables = tables.withColumn("_block", floor_div(F.col("_slice"), SLICES_PER_BLOCK))
    blocks = tables.groupBy(*per_block).applyInArrow(
        _compose_tables(len(per_block)), _schema(tables, per_block, "_until array<bigint>, _out array<bigint>")
    )
    block_entries = (
        blocks.withColumn("_state", F.lit(_NEVER))
        .groupBy(*full)
        .applyInArrow(_chain_tables("_block"), _schema(blocks, per_block, "_entry bigint"))
    )
    entries = (
        tables.join(block_entries.withColumnRenamed("_entry", "_state"), per_block)
        .groupBy(*per_block)
        .applyInArrow(_chain_tables("_slice"), _schema(tables, [*grouped, "_block"], "_entry bigint"))
        .drop("_block")
    )

    # Roots open bursts. Of the others, only those after the deadline of the latest root may.
    deadline = F.col("_latest_root") + span
    beyond = ~F.col("_root") & (F.col("_latest_root").isNull() | (F.col("_us") > deadline))
    order = Window.partitionBy(*grouped).orderBy("_us", "_seq")
    undecided = fails.where((F.col("_root") & F.col("_alarm")) | beyond).select(
        *grouped, "_us", "_seq", "_root", "_n", "_last", "_alarm", "_latest_root"
    )
    # The window comes after the join, so Spark must keep each slice in one partition for it.
    same_run = F.coalesce(F.lag("_latest_root").over(order) == F.col("_latest_root"), F.lit(False))
    unrooted = F.col("_latest_root").isNull() & (F.row_number().over(order) > 1)
    entered = undecided.join(entries, grouped, "left").withColumns(
        {
            "_head": ~same_run & ~unrooted,
            "_entry": F.coalesce(deadline, "_entry", F.lit(_NEVER)),
            "_opens": F.col("_root"),
        }
    )
    ordered = entered.drop("_latest_root").sortWithinPartitions(*grouped, "_us", "_seq")
    opened = ordered.mapInArrow(_mark_openings(span), ordered.schema)
    return show_nulls(opened.where(F.col("_opens") & F.col("_alarm")), keys).select(
        *keys,
        from_micros(F.col("_us"), kind).alias("first_ts"),
        F.col("_seq").alias("first_seq"),
        from_micros(F.col("_last"), kind).alias("last_ts"),
        F.col("_n").alias("n_fails"),
    )


def _rooted_failures(rows: DataFrame, grouped: list[str], span: int, width: int, min_failures: int) -> DataFrame:
    """The failures of each slice, preceded by those of the run it starts in if that run's root is near.

    ``_root`` tells roots; ``_alarm``, ``_n`` and ``_last`` describe the burst an own failure would
    open; ``_chained`` marks all failures of a slice that takes or gives a state across its border.
    """
    halo = min(HALO_SPANS * span, width // HALO_PART)
    forward = Window.partitionBy(*grouped).orderBy("_us", "_seq")
    seen = forward.rowsBetween(Window.unboundedPreceding, 0)
    to_deadline = Window.partitionBy(*grouped).orderBy("_us").rangeBetween(Window.unboundedPreceding, span)
    fail_us = F.when(F.col("_fail"), F.col("_us"))
    success = F.when(~F.col("_fail"), 1)
    counted = with_halo(rows, "_us", width, back=halo + span, ahead=span).withColumns(
        {
            "_prev_us": F.lag("_us").over(forward),
            "_prev_fail": F.lag("_fail").over(forward),
            "_next_us": F.lead("_us").over(forward),
            "_next_fail": F.lead("_fail").over(forward),
            "_next_own": F.lead("_own").over(forward),
            "_n": F.count(fail_us).over(to_deadline) - F.count(fail_us).over(seen) + 1,
            "_successes": F.count(success).over(to_deadline) - F.count(success).over(seen),
            "_last": F.max(fail_us).over(to_deadline),
        }
    )
    follows = F.coalesce(F.col("_prev_fail") & (F.col("_us") - F.col("_prev_us") <= span), F.lit(False))
    followed = F.coalesce(F.col("_next_fail") & (F.col("_next_us") - F.col("_us") <= span), F.lit(False))
    begin, end = F.col("_slice") * width, (F.col("_slice") + 1) * width
    leaves = followed & F.col("_own") & ~F.col("_next_own")
    fails = counted.where(F.col("_fail") & (F.col("_us") >= begin - halo) & (F.col("_us") < end)).select(
        *grouped,
        "_us",
        "_seq",
        "_own",
        (~follows).alias("_root"),
        "_n",
        "_last",
        (F.col("_own") & (F.col("_successes") == 0) & (F.col("_n") >= min_failures)).alias("_alarm"),
        F.coalesce(leaves, F.lit(False)).alias("_leaves"),
    )
    latest_root = F.max(F.when(F.col("_root"), F.col("_us"))).over(seen)
    takes = F.col("_own") & F.col("_latest_root").isNull()
    gives = F.col("_leaves") & (F.col("_latest_root").isNull() | (F.col("_latest_root") < end - halo))
    return (
        fails.withColumn("_latest_root", latest_root)
        .where(F.col("_own") | F.col("_latest_root").isNotNull())
        .withColumn("_chained", F.max(takes | gives).over(Window.partitionBy(*grouped)))
        .drop("_leaves")
    )


def _schema(df: DataFrame, columns: list[str], extra: str) -> T.StructType:
    added = T.StructType.fromDDL(extra)
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns] + added.fields)


def _walk(us: np.ndarray, until: int, span: int) -> list[int]:
    """Positions opened in a run of failures, when the burst before it lasts to ``until``."""
    opened = []
    at = int(np.searchsorted(us, until, side="right"))
    while at < len(us):
        opened.append(at)
        at = int(np.searchsorted(us, us[at] + span, side="right"))
    return opened


def _transfer_table(span: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Per slice: for a burst carried in that lasts to less than ``_until[i]``, the last deadline is ``_out[i]``."""

    def table(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_us", "ascending"), ("_seq", "ascending")])
        us = rows.column("_us").to_numpy()
        roots = np.flatnonzero(rows.column("_root").to_numpy().astype(bool))
        if len(roots):
            run = us[roots[-1]:]
            until, out = [1 << 62], [int(run[_walk(run, _NEVER, span)[-1]]) + span]
        else:
            # The next opening after each failure; following it repeatedly by doubling gives the last one.
            last = np.searchsorted(us, us + span, side="right")
            last = np.where(last < len(us), last, np.arange(len(us)))
            while True:
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            # A carried burst ends within ``span`` of the first failure, so later failures cannot come first.
            first = np.flatnonzero(us <= us[0] + span + span)
            deadline = us[last[first]] + span
            step = np.append(deadline[1:] != deadline[:-1], True)
            until, out = us[first][step].tolist(), deadline[step].tolist()
        columns = [pa.array([k.as_py()], type=rows.schema.field(i).type) for i, k in enumerate(key)]
        names = rows.schema.names[: len(key)]
        columns += [pa.array([until], type=pa.list_(pa.int64())), pa.array([out], type=pa.list_(pa.int64()))]
        return pa.table(columns, names=[*names, "_until", "_out"])

    return table


def _advance(until: np.ndarray, out: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Look states up in a table; a state that outlasts the table stays as it is."""
    at = np.searchsorted(until, state, side="right")
    return np.where(at < len(out), out[np.minimum(at, len(out) - 1)], state)


def _table_columns(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for until, out in zip(rows.column("_until"), rows.column("_out")):
        yield until.values.to_numpy(), out.values.to_numpy()


def _compose_tables(n_keys: int) -> Callable[[pa.Table], pa.Table]:
    """One table for a block of slices. A slice whose predecessor is missing starts from a root, so gaps need no care."""

    def compose(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_slice")
        until, out = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for next_until, next_out in _table_columns(rows):
            later = next_until > until[-1] if len(until) else np.ones(len(next_until), dtype=bool)
            until = np.append(until, next_until[later])
            out = np.append(_advance(next_until, next_out, out), next_out[later])
            step = np.append(out[1:] != out[:-1], True)
            until, out = until[step], out[step]
        names = [n for n in rows.schema.names if n not in ("_slice", "_until", "_out")][:n_keys]
        lists = [pa.array([v], type=pa.list_(pa.int64())) for v in (until, out)]
        first = rows.slice(0, 1)
        return pa.table([*(first.column(n) for n in names), *lists], names=[*names, "_until", "_out"])

    return compose


def _chain_tables(order: str) -> Callable[[pa.Table], pa.Table]:
    """Deadline carried into each row's slice or block, starting from the group's ``_state``."""

    def chain(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        state, entries = rows.column("_state")[0].as_py(), []
        for until, out in _table_columns(rows):
            entries.append(state)
            state = int(_advance(until, out, np.array([state]))[0])
        kept = rows.drop_columns(["_until", "_out", "_state"])
        return kept.append_column("_entry", pa.array(entries, type=pa.int64()))

    return chain


def _mark_openings(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Set ``_opens`` on the failures that open a burst; rows come in order, groups start at ``_head``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        until = _NEVER
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            us, head, root, entry = (
                batch.column(names.index(n)).to_numpy(zero_copy_only=False) for n in ("_us", "_head", "_root", "_entry")
            )
            opens = root.astype(bool).copy()
            begins = np.flatnonzero(opens | head.astype(bool))
            if len(begins) == 0 or begins[0] != 0:
                begins = np.insert(begins, 0, 0)
            ends = np.append(begins[1:], len(us))
            first = us[begins]
            # A run that starts with a root and fits one burst opens nothing else.
            follow = ~opens[begins] | (us[ends - 1] > first + span)
            follow[-1] = True
            for i in np.flatnonzero(follow):
                lo, hi = begins[i], ends[i]
                carried = _NEVER if opens[lo] else (int(entry[lo]) if head[lo] else until)
                opened = _walk(us[lo:hi], carried, span)
                opens[lo + np.array(opened, dtype=np.int64)] = True
                until = int(us[lo + opened[-1]]) + span if opened else carried
            at = names.index("_opens")
            columns = batch.columns
            columns[at] = pa.array(opens)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return mark
