"""Window Top-N kept in list state: n rows per window and salt, answered when the watermark passes the window's end."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import nsmallest
from itertools import chain
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class BestRows(StatefulProcessor):
    """The best ``n`` rows of a (window end, salt); a row's order is its count, then its keys."""

    def __init__(self, n: int, keys: list[str], rows: T.StructType, columns: list[str]):
        self.n, self.keys, self.rows, self.columns = n, keys, rows, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.rows)

    @staticmethod
    def _order(row: tuple) -> tuple:
        *keys, cnt = row
        return -cnt, [(key is not None, key) for key in keys]

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = [tuple(row) for row in self.best.get()]
        if not held:
            self.handle.registerTimer(-(-key[0] // 1000))
        arrived = ((*(row[k] for k in self.keys), row["cnt"]) for row in rows)
        self.best.put(nsmallest(self.n, chain(held, arrived), key=self._order))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        for row in self.best.get():
            yield Row(**dict(zip(self.columns, (*key, *row))))
        self.best.clear()

    def close(self) -> None:
        pass


def stream_best_rows(counts: DataFrame, n: int, keys: Sequence[str], salts: int = 16) -> DataFrame:
    """Rows of ``counts`` (``keys``, ``window_end``, ``cnt``) that may be among the best ``n`` of their window.

    ``counts`` come in append mode, once per key and window, as from ``stream_counts``. The state of a window is ``n`` rows
    for each of ``salts`` parts of its keys, so a window of very many keys is in several state partitions and at most
    ``n * salts`` rows of it leave, for ``ranked_sink`` to rank.
    """
    keys = list(keys)
    end = F.unix_micros("window_end").alias("_end")
    salt = F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int").alias("_salt")
    rows = counts.select(end, salt, *keys, F.col("cnt").cast("bigint").alias("cnt"))
    held = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields[2:]])
    schema = T.StructType([*rows.schema.fields[:2], *held.fields])
    best = rows.groupBy("_end", "_salt").transformWithState(BestRows(n, keys, held, schema.names), schema, "Append", "EventTime")
    return best.select(*keys, F.timestamp_micros("_end").alias("window_end"), "cnt")
