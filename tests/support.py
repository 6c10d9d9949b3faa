"""Small random event frames and plain-Python state machines to check the operators against."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

EPOCH = datetime(1970, 1, 1)
START = 1_511_658_000


def at(second: float) -> datetime:
    return EPOCH + timedelta(seconds=second)


def frame(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Rows given with ``ts`` in epoch seconds; the frame has a zone-less timestamp."""
    names = [c.split()[0] for c in columns.split(",")]
    where = names.index("ts")
    typed = [tuple(at(v) if i == where else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(typed, columns)


def random_events(
    seed: int, keys: int, longest: int, kinds: list[str], gap: int, hot: int = 0
) -> list[tuple[int, int, str, int]]:
    """``(seq, key, kind, second)`` in arrival order; times jitter and repeat. Key 0 gets ``hot`` extra rows."""
    rng = random.Random(seed)
    rows = []
    for key in range(keys):
        second = START + rng.randrange(50)
        for _ in range(rng.randrange(1, longest) + (hot if key == 0 else 0)):
            second += rng.choice([0, 0, 1, 1, 2, gap])
            rows.append((key, rng.choice(kinds), max(START - 60, second - rng.choice([0, 0, 0, 1, 3]))))
    rng.shuffle(rows)
    return [(i, *r) for i, r in enumerate(rows)]


def by_key(events: list[tuple[int, int, str, int]]) -> dict[int, list[tuple[int, int, str]]]:
    """Per key ``(second, seq, kind)`` in event-time order."""
    groups = defaultdict(list)
    for seq, key, kind, second in events:
        groups[key].append((second, seq, kind))
    return {k: sorted(v) for k, v in groups.items()}


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expect(df: DataFrame, expected: list[tuple]) -> None:
    assert rows_of(df) == sorted((tuple(r) for r in expected), key=repr)
