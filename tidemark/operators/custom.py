"""Aggregates of one's own, written as zero / add / merge / finish.

Map tasks fold their rows into one partial per key, batch by batch in Arrow, before anything is shuffled: a hot key leaves a
task as one row. Behind the shuffle partials arrive sorted and are merged as they pass, so a task holds one state (or, for
sliding windows, those of one window's panes), however many keys or partials it has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from math import gcd
from operator import itemgetter
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.clock import Span, floor_div, from_micros, micros, span_us

State = tuple
PANE, SLICE, WINDOW = "_pane", "_slice", "_i"
#: Keys that a map task holds before it hands their partials on.
HELD_KEYS = 50_000
#: Rows of a batch that a task gives back.
BATCH_ROWS = 10_000


class Aggregate:
    """What to fold: ``merge`` must not depend on how rows are divided, nor on their order.

    ``inputs`` are the columns read, ``state`` and ``result`` name and type the values of a state and of a result, in order.
    """

    inputs: Sequence[str] = ()
    state: str
    result: str

    def zero(self) -> State:
        raise NotImplementedError

    def add(self, state: State, rows: pa.Table) -> State:
        """``state`` after all of ``rows``, a key's rows of one batch with the columns ``inputs``."""
        raise NotImplementedError

    def merge(self, one: State, other: State) -> State:
        raise NotImplementedError

    def finish(self, state: State) -> tuple:
        return state


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in held], field.type) for i, field in enumerate(schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _groups(table: pa.Table, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The keys of a batch, each with its rows."""
    if not keys:
        yield (), table
        return
    names = [f"k{i}" for i in range(len(keys))]
    numbered = pa.table([*(table[k] for k in keys), np.arange(table.num_rows)], names=[*names, "row"])
    found = numbered.group_by(names, use_threads=False).aggregate([("row", "list")])
    rows = found["row_list"].combine_chunks()
    ordered, ends = table.take(rows.flatten()), rows.offsets.to_pylist()
    for n, key in enumerate(zip(*(found[name].to_pylist() for name in names))):
        yield key, ordered.slice(ends[n], ends[n + 1] - ends[n])


def _partials(df: DataFrame, keys: list[str], aggregate: Aggregate) -> tuple[DataFrame, list[str]]:
    """One row per key and map task (more if a task has over HELD_KEYS keys): the key and its state."""
    for key in keys:
        kind = df.schema[key].dataType
        if isinstance(kind, (T.FractionalType, T.ArrayType, T.MapType, T.StructType, T.VariantType)) and not isinstance(kind, T.DecimalType):
            raise TypeError(f"key {key} of type {kind.simpleString()} has no plain equality")
    held_fields = [T.StructField(f"_s{i}", f.dataType) for i, f in enumerate(_fields(aggregate.state))]
    schema = T.StructType([*(df.schema[k] for k in keys), *held_fields])
    arrow = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    inputs = list(aggregate.inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def partials() -> Iterator[tuple]:
            held: dict[tuple, State] = {}
            for batch in batches:
                for key, rows in _groups(pa.Table.from_batches([batch]), keys):
                    held[key] = aggregate.add(held[key] if key in held else aggregate.zero(), rows.select(inputs))
                if len(held) > HELD_KEYS:
                    yield from ((*key, *state) for key, state in held.items())
                    held.clear()
            yield from ((*key, *state) for key, state in held.items())

        return _batches(partials(), arrow)

    read = list(dict.fromkeys([*keys, *inputs])) or [F.lit(0).alias("_none")]
    return df.select(*read).mapInArrow(run, schema), [f.name for f in held_fields]


def _fields(ddl: str) -> list[T.StructField]:
    return list(T._parse_datatype_string(ddl).fields)


def _gathered(partials: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    spread = partials.repartition(*by) if by else partials.repartition(1)
    return spread.sortWithinPartitions(*order) if order else spread


def _merged(rows: Iterator[tuple], width: int, aggregate: Aggregate) -> Iterator[tuple[tuple, State]]:
    """Neighbouring rows of one key, merged."""
    for key, same in groupby(rows, key=itemgetter(slice(width))):
        state = None
        for row in same:
            state = row[width:] if state is None else aggregate.merge(state, row[width:])
        yield key, state


def custom_aggregate(df: DataFrame, keys: Sequence[str], aggregate: Aggregate) -> DataFrame:
    """``aggregate`` per key: ``keys`` and the columns of ``aggregate.result``.

    Null keys are a key like any other. Without keys there is one row, or none for an empty frame. Windows are keys too:
    add their start first, or use ``custom_sliding``.
    """
    keys = list(keys)
    partials, held = _partials(df, keys, aggregate)
    schema = T.StructType([*(df.schema[k] for k in keys), *_fields(aggregate.result)])
    arrow = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((*key, *aggregate.finish(s)) for key, s in _merged(_rows(batches), width, aggregate)), arrow)

    return _gathered(partials, keys, keys).select(*keys, *held).mapInArrow(run, schema)


class _Panes:
    """The panes of a window, oldest first, as two stacks: each pane is merged about twice, whatever the overlap."""

    def __init__(self, aggregate: Aggregate):
        self.merge = aggregate.merge
        self.old: list[tuple[int, State]] = []  # newest first, each merged with all newer ones of this stack
        self.new: list[tuple[int, State]] = []
        self.new_state: Any = None

    def __bool__(self) -> bool:
        return bool(self.old or self.new)

    def add(self, pane: int, state: State) -> None:
        self.new.append((pane, state))
        self.new_state = state if self.new_state is None else self.merge(self.new_state, state)

    def drop_before(self, pane: int) -> None:
        while self:
            if not self.old:
                state = None
                for at, one in reversed(self.new):
                    state = one if state is None else self.merge(one, state)
                    self.old.append((at, state))
                self.new, self.new_state = [], None
            if self.old[-1][0] >= pane:
                return
            self.old.pop()

    def total(self) -> State:
        if not self.old:
            return self.new_state
        return self.old[-1][1] if self.new_state is None else self.merge(self.old[-1][1], self.new_state)


def _windows(panes: Iterator[tuple[int, State]], first: int, last: int, step: int, wide: int, aggregate: Aggregate) -> Iterator[tuple[int, State]]:
    """Windows ``first`` to ``last`` that hold a pane; window ``i`` is the ``wide`` panes from ``i * step``."""
    held, at = _Panes(aggregate), first

    def before(pane: int | None) -> Iterator[tuple[int, State]]:
        """Windows that end before ``pane``, all of them without one."""
        nonlocal at
        while at <= last and (pane is None or at * step + wide <= pane):
            held.drop_before(at * step)
            if not held:
                return
            yield at, held.total()
            at += 1

    for pane, state in panes:
        yield from before(pane)
        held.drop_before(at * step)
        if not held:
            at = max(at, -((wide - 1 - pane) // step))
        held.add(pane, state)
    yield from before(None)


def custom_sliding(
    df: DataFrame,
    ts: str,
    size: Span,
    slide: Span,
    keys: Sequence[str],
    aggregate: Aggregate,
    windows_per_slice: int | None = None,
) -> DataFrame:
    """``aggregate`` per key and sliding window that holds a row, at about three merges a window whatever the overlap.

    Rows shrink to panes in the map tasks. A key's panes are cut into slices of ``windows_per_slice`` windows, so a hot key is
    in many tasks; panes near a border are copied. Rows without a time are in no window.
    """
    keys = list(keys)
    size_us, slide_us = span_us(size), span_us(slide)
    pane_us = gcd(size_us, slide_us)
    wide, step = size_us // pane_us, slide_us // pane_us
    per_slice = windows_per_slice or max(1024, 4 * -(-wide // step))
    timed = df.withColumn(PANE, floor_div(micros(df, ts), pane_us)).where(F.col(PANE).isNotNull())
    partials, held = _partials(timed, [*keys, PANE], aggregate)
    first = floor_div(-floor_div(F.lit(wide - 1) - F.col(PANE), step), per_slice)
    last = floor_div(floor_div(F.col(PANE), step), per_slice)
    # Where the slide is longer than a window, some panes are in none.
    copies = partials.where(-floor_div(F.lit(wide - 1) - F.col(PANE), step) <= floor_div(F.col(PANE), step))
    copies = copies.select(*keys, F.explode(F.sequence(first, last)).alias(SLICE), PANE, *held)
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(WINDOW, T.LongType()), *_fields(aggregate.result)])
    arrow = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[tuple]:
            panes = _merged(_rows(batches), width + 2, aggregate)
            for (*key, piece), same in groupby(panes, key=lambda p: p[0][: width + 1]):
                timeline = ((place[-1], state) for place, state in same)
                for at, state in _windows(timeline, piece * per_slice, (piece + 1) * per_slice - 1, step, wide, aggregate):
                    yield (*key, at, *aggregate.finish(state))

        return _batches(windows(), arrow)

    found = _gathered(copies, [*keys, SLICE], [*keys, SLICE, PANE]).mapInArrow(run, schema)
    kind = df.schema[ts].dataType
    start = F.col(WINDOW) * slide_us
    return found.select(
        *keys, from_micros(start, kind).alias("window_start"), from_micros(start + size_us, kind).alias("window_end"),
        *[f.name for f in _fields(aggregate.result)],
    )
