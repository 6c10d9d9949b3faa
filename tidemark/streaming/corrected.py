"""Windows that answer when the watermark passes their end and once more for each batch of allowed late rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.clock import Span, floor_div, micros, span_us
from tidemark.operators.lateness import LAST_INSTANT_US
from tidemark.streaming.windows import event_time

FIRST, CORRECTED, LATE = "first", "corrected", "late"


class TwoTimers(StatefulProcessor):
    """One window of one key: a timer to answer at its end, and one to forget it when lateness ends.

    Spark's watermark runs ``behind`` the one that closes windows, so that no row of a window still kept is dropped before
    it comes here; times are moved back by as much.
    """

    def __init__(self, size: int, allowed: int, behind: int, columns: list[str]):
        self.size, self.allowed, self.behind, self.columns = size, allowed, behind, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "cnt BIGINT, answered BOOLEAN")

    def _row(self, key: Any, answer: str, cnt: int) -> Row:
        return Row(**dict(zip(self.columns, (*key, answer, cnt))))

    def _watermark(self, timerValues: Any) -> int:
        return timerValues.getCurrentWatermarkInMs() * 1000 + self.behind

    def _wake_at(self, us: int) -> None:
        self.handle.registerTimer(max(0, -(-(us - self.behind) // 1000)))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        arrived = sum(r["_n"] for r in rows)
        closes = key[-1] + self.size - LAST_INSTANT_US
        now = self._watermark(timerValues)
        if closes + self.allowed <= now:
            yield self._row(key, LATE, arrived)
            return
        held = self.window.get()
        cnt, answered = (held[0] + arrived, held[1]) if held is not None else (arrived, False)
        if held is None:
            self._wake_at(closes + self.allowed)
        if closes <= now:
            if held is not None and not answered:
                # The watermark passed before these rows came: their timer would speak after them.
                yield self._row(key, FIRST, held[0])
            yield self._row(key, FIRST if held is None else CORRECTED, cnt)
            answered = True
        elif held is None:
            self._wake_at(closes)
        self.window.update((cnt, answered))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.window.get()
        if held is None:
            return
        cnt, answered = held
        if not answered:
            yield self._row(key, FIRST, cnt)
        if key[-1] + self.size - LAST_INSTANT_US + self.allowed <= self._watermark(timerValues):
            self.window.clear()
        elif not answered:
            self.window.update((cnt, True))

    def close(self) -> None:
        pass


def stream_counts_corrected(
    stream: DataFrame,
    ts: str,
    size: Span,
    slide: Span | None = None,
    keys: Sequence[str] = (),
    delay: Span = "1 millisecond",
    allowed: Span = "0 seconds",
) -> DataFrame:
    """Row counts per key and window with an early ``first`` answer and ``corrected`` ones for ``allowed`` late time.

    A window answers when the watermark, ``delay`` behind the latest row, passes its end; every later batch that brings
    rows for it answers anew at once, until the watermark is ``allowed`` beyond the end and the window is forgotten. Rows
    that come still later are counted per window in answers called ``late``. The last answer of a window other than that
    is its final count. The watermark is that of the batches before. Rows without a time belong to no window. State is
    keyed by key and window.
    """
    keys = list(keys)
    size_us, allowed_us = span_us(size), span_us(allowed)
    slide_us = span_us(slide) if slide is not None else size_us
    behind = allowed_us + size_us
    timed = event_time(stream, ts, f"{span_us(delay) + behind} microseconds")
    us = micros(timed, ts)
    starts = F.sequence(floor_div(us - size_us, slide_us) + 1, floor_div(us, slide_us))
    # The condition on the time stays above the watermark.
    windows = timed.select(*keys, ts, F.explode(starts).alias("_start"), F.lit(1).alias("_n"))
    windows = windows.withColumn("_start", F.col("_start") * slide_us)
    by = [*keys, "_start"]
    schema = T.StructType([windows.schema[k] for k in by] + T.StructType.fromDDL("answer STRING, cnt BIGINT").fields)
    found = windows.groupBy(*by).transformWithState(TwoTimers(size_us, allowed_us, behind, schema.names), schema, "Append", "EventTime")
    return found.select(
        *keys, F.timestamp_micros("_start").alias("window_start"), F.timestamp_micros(F.col("_start") + size_us).alias("window_end"), "answer", "cnt"
    )
