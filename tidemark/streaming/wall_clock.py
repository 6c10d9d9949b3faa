"""Daily caps by the wall clock: ranks follow arrival, and a processing-time timer forgets a key at local midnight.

Unlike ``stream_cap_outcomes`` a replay gives other ranks than the first run did; in exchange every row is answered in the batch
it arrives in, without a watermark. Keys are dealt to groups, as in ``stateful``: state is a number per key with rows today,
and the day and a timer per group.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.clock import DAY_US, Span, span_us
from tidemark.operators.capping import DROP, PASS, WARN
from tidemark.streaming.stateful import PACKED_ROWS, Crowd, bucket_of, key_name, named_keys, unpacked

RESET = "reset"
#: Set to false where such a stream runs with ``availableNow``: Spark asks for batches without data as long as timers may fire.
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
DAY_MS = DAY_US // 1000


_OUTPUT = "_seq STRING, day_rank BIGINT, outcome STRING"


class ClockCap(StatefulProcessor):
    """``clock`` turns Spark's processing time of a batch into the time of day to use, both in milliseconds.

    A row's last column is a text of the name of its key and, in a new line, its number; results go out as JSON texts of many.
    """

    def __init__(self, cap: int, offset_ms: int, clock: Callable[[int], int]):
        self.cap, self.offset, self.clock = cap, offset_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.today = handle.getValueState("today", "day BIGINT, timer BIGINT, json STRING")
        self.blocks = handle.getMapState("blocks", "number BIGINT", "json STRING")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        real = timerValues.getCurrentProcessingTimeInMs()
        now = self.clock(real) + self.offset
        day, timer, held = self.today.get() or (None, None, "[{}, []]")
        crowd = Crowd(self.blocks, *json.loads(held))
        if day != now // DAY_MS:
            if day is not None:  # rows of the new day come in before the timer does
                self.handle.deleteTimer(timer)
                yield from self._packed(self._resets(crowd))
            day = now // DAY_MS
            timer = real + (day + 1) * DAY_MS - now
            self.handle.registerTimer(timer)
        yield from self._packed(self._ranked(crowd, rows))
        self.today.update((day, timer, json.dumps(crowd.save())))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        crowd = Crowd(self.blocks, *json.loads(self.today.get()[2]))
        yield from self._packed(self._resets(crowd))
        crowd.save()
        self.today.clear()

    def _ranked(self, crowd: Crowd, rows: Iterator[Row]) -> Iterator[tuple]:
        for *_, text in rows:
            name, *seq = text.split("\n", 1)
            item = crowd.get(name)
            if item is None:
                item = crowd.items[name] = [None, 0]
            item[1] += 1
            n = item[1]
            yield name, *(seq or [None]), n, PASS if n <= self.cap else WARN if n == self.cap + 1 else DROP

    def _resets(self, crowd: Crowd) -> Iterator[tuple]:
        for name, (_, n) in crowd.take():
            yield name, None, n, RESET

    def _packed(self, outputs: Iterator[tuple]) -> Iterator[Row]:
        columns = ("_name", "_seq", "day_rank", "outcome")
        while rows := list(islice(outputs, PACKED_ROWS)):
            yield Row(out=json.dumps([dict(zip(columns, row)) for row in rows]))

    def close(self) -> None:
        pass


def _as_it_is(ms: int) -> int:
    return ms


def stream_cap_by_clock(
    stream: DataFrame,
    keys: Sequence[str],
    seq: str,
    cap: int,
    utc_offset: Span = "8 hours",
    clock: Callable[[int], int] = _as_it_is,
) -> DataFrame:
    """Rank of each row of a key since local midnight as it arrives, and whether it passes, warns or is dropped.

    When the clock reaches midnight the state is dropped and for each key a row ``reset`` tells how many rows it had; ``seq`` of it is
    null. Timers fire with the next batch after their time. ``clock`` can be replaced to run at another time of day; it must be
    the same for all tasks. Null keys are a key. Event times are not looked at. With ``availableNow`` set ``NO_DATA_BATCHES`` to
    false, or the run does not end.
    """
    keys = list(keys)
    name = key_name(stream, keys)
    rows = stream.select(bucket_of(name).alias("_group"), F.concat_ws("\n", name, F.col(seq).cast("string")).alias("_row"))
    processor = ClockCap(cap, span_us(utc_offset) // 1000, clock)
    packed = rows.groupBy("_group").transformWithState(processor, "out STRING", "Append", "ProcessingTime")
    out = named_keys(unpacked(packed, _OUTPUT), F.col("_name"), stream, keys)
    return out.select(*keys, F.col("_seq").cast(stream.schema[seq].dataType).alias(seq), "day_rank", "outcome")
