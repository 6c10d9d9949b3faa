import pytest

from collections import Counter

from tests.support import at, expect, frame, random_events
from tidemark.operators import classify_lateness, sliding_counts_with_lateness

EVENTS = random_events(9, 12, 40, ["GET", "POST"], gap=15)
COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"
DELAY, ALLOWED, SIZE, SLIDE = 3, 30, 60, 5


def arrivals():
    seen = None
    for seq, key, kind, second in EVENTS:
        yield seq, key, kind, second, None if seen is None else seen - DELAY
        seen = second if seen is None else max(seen, second)


@pytest.mark.parametrize("chunk", [1, 13, 5_000_000])
def test_lateness_and_counts(spark, chunk):
    df = frame(spark, EVENTS, COLUMNS)
    want, counts = [], Counter()
    for seq, key, kind, second, wm in arrivals():
        i = second // SLIDE
        last_end = i * SLIDE + SIZE
        late = wm is not None and last_end - 0.001 + ALLOWED <= wm
        want.append((seq, late, None if wm is None else at(wm)))
        while i * SLIDE > second - SIZE:
            if wm is None or i * SLIDE + SIZE - 0.001 + ALLOWED > wm:
                counts[(key, i)] += 1
            i -= 1
    classified = classify_lateness(df, "ts", "seq", "3 seconds", "30 seconds", "60 seconds", "5 seconds", chunk)
    expect(classified.select("seq", "is_late", "watermark"), want)
    assert any(late for _, late, _ in want)
    got = sliding_counts_with_lateness(classified, "ts", "30 seconds", "60 seconds", "5 seconds", ["key"])
    expect(
        got.select("key", "window_end", "cnt"), [(k, at(i * SLIDE + SIZE), n) for (k, i), n in counts.items()]
    )


def test_rows_without_time_or_number_are_kept_and_not_late(spark):
    rows = [(0, at(1000)), (None, at(1)), (1, None), (2, at(1)), (None, None)]
    df = spark.createDataFrame(rows, "seq bigint, ts timestamp_ntz")
    got = classify_lateness(df, "ts", "seq", "3 seconds", "30 seconds", "60 seconds", chunk_rows=1)
    assert sorted((str(r.seq), r.is_late) for r in got.collect()) == [("0", False), ("1", False), ("2", True), ("None", False), ("None", False)]
