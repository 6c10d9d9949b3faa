"""Caps by the wall clock, with a clock of the test's own."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq

from tidemark import streaming
from tidemark.streaming.wall_clock import DAY_MS, NO_DATA_BATCHES

COLUMNS = "seq bigint, key bigint"


def test_midnight_resets_by_timer_and_by_rows(spark, tmp_path, request):
    spark.conf.set(NO_DATA_BATCHES, "false")
    request.addfinalizer(lambda: spark.conf.unset(NO_DATA_BATCHES))

    def put(number, rows):
        target = tmp_path / "events" / f"part-{number}.parquet"
        target.parent.mkdir(exist_ok=True)
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
        pq.write_table(pa.table(columns, ["seq", "key"]), target)
        os.utime(target, (1_000_000 + number, 1_000_000 + number))

    def run(clock):
        stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "events"))
        capped = streaming.stream_cap_by_clock(stream, ["key"], "seq", 2, "0 hours", clock)
        sink = streaming.changelog_sink(capped, str(tmp_path / "out"), mode="append")
        sink.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).select("key", "seq", "day_rank", "outcome").collect()
        return sorted((tuple(r) for r in rows), key=repr)

    # Four rows of a key and one without a key, half a second before midnight of day 10.
    put(0, [(1, 7), (2, 7), (3, 7), (4, 7), (5, None)])
    first = run(lambda ms: 11 * DAY_MS - 500)
    assert {(k, n, o) for k, _, n, o in first} == {(7, 1, "pass"), (7, 2, "pass"), (7, 3, "warn"), (7, 4, "drop"), (None, 1, "pass")}
    time.sleep(1)
    # Midnight has passed for the timers: they fire in a batch of another key's rows. Key 8 waits for a midnight far away.
    put(2, [(6, 8), (7, 8)])
    second = run(lambda ms: 11 * DAY_MS + 1)
    fired = [row for row in second if row not in first]
    assert sorted(fired, key=repr) == sorted([(8, 6, 1, "pass"), (8, 7, 2, "pass"), (7, None, 4, "reset"), (None, None, 1, "reset")], key=repr)
    # Both keys begin anew; key 8 by its row, as the day has changed although its timer has not fired.
    put(3, [(8, 7), (9, 8)])
    third = run(lambda ms: 12 * DAY_MS + 1)
    late = [row for row in third if row not in second]
    assert sorted(late, key=repr) == sorted([(7, 8, 1, "pass"), (8, 9, 1, "pass"), (8, None, 2, "reset")], key=repr)


def test_many_keys_share_state(spark, tmp_path, monkeypatch, request):
    """State does not grow by a value and a timer for each key; numbers of rows may be texts."""
    from tidemark.streaming import stateful

    for name, value in (("BUCKETS", 2), ("FEW_KEYS", 3), ("KEY_BLOCKS", 5), ("PACKED_ROWS", 7)):
        monkeypatch.setattr(stateful, name, value, raising=False)
    spark.conf.set(NO_DATA_BATCHES, "false")
    request.addfinalizer(lambda: spark.conf.unset(NO_DATA_BATCHES))
    (tmp_path / "events").mkdir()

    def run(number, keys, clock):
        rows = [(f"{number} {i}\n", k, f"ad {k % 3}") for i, k in enumerate(keys)]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))]
        pq.write_table(pa.table(columns, ["seq", "key", "ad"]), tmp_path / "events" / f"part-{number}.parquet")
        stream = spark.readStream.schema("seq string, key bigint, ad string").parquet(str(tmp_path / "events"))
        capped = streaming.stream_cap_by_clock(stream, ["key", "ad"], "seq", 1, "0 hours", clock)
        sink = streaming.changelog_sink(capped, str(tmp_path / "out"), mode="append")
        query = sink.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out")).where(f"_batch = {number}")
        return {tuple(r) for r in found.select("key", "ad", "seq", "day_rank", "outcome").collect()}, query.lastProgress.stateOperators[0].numRowsTotal

    first, held = run(0, [*range(60), *range(60)], lambda ms: 11 * DAY_MS - 500)
    want = {(k, f"ad {k % 3}", f"0 {k + 60 * n}\n", n + 1, ("pass", "warn")[n]) for k in range(60) for n in (0, 1)}
    # Which of a key's rows is read first is not fixed.
    assert {(k, a, n, o) for k, a, _, n, o in first} == {(k, a, n, o) for k, a, _, n, o in want}
    assert {s for _, _, s, _, _ in first} == {s for _, _, s, _, _ in want}
    assert 0 < held < 40
    time.sleep(1)
    second, _ = run(1, [60], lambda ms: 11 * DAY_MS + 1)
    assert second == {(60, "ad 0", "1 0\n", 1, "pass")} | {(k, f"ad {k % 3}", None, 2, "reset") for k in range(60)}
