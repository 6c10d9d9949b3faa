import pytest
from pyspark.sql import functions as F

from tests.support import START, at, by_key, expect, frame, random_events
from tidemark.operators import bursts, failure_bursts

COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"


def brute(events, within, least):
    out = []
    for key, rows in by_key(events).items():
        opened = []
        for second, seq, kind in rows + [(1 << 40, -1, "success")]:
            if opened and second > opened[0][0] + within:
                if len(opened) >= least:
                    out.append((key, at(opened[0][0]), opened[0][1], at(opened[-1][0]), len(opened)))
                opened = []
            if kind == "fail":
                opened.append((second, seq))
            else:
                opened = []
    return out


@pytest.mark.parametrize("kinds,gap", [(["fail", "success"], 9), (["fail"] * 9 + ["success"], 4), (["fail"], 3), (["fail"], 12)])
@pytest.mark.parametrize("slice", ["5 seconds", None])
def test_bursts_equal_the_state_machine(spark, kinds, gap, slice):
    events = random_events(6, 40, 40, kinds, gap=gap, hot=600)
    df = frame(spark, events, COLUMNS)
    got = failure_bursts(df, ["key"], "ts", "seq", F.col("kind") == "fail", "5 seconds", 3, slice)
    expect(got, brute(events, 5, 3))


@pytest.mark.parametrize("per_block", [1, 7, 256])
def test_one_key_failing_without_pause_crosses_many_slices(spark, monkeypatch, per_block):
    monkeypatch.setattr(bursts, "SLICES_PER_BLOCK", per_block)
    events = [(i, 1, "fail", START + i) for i in range(2000)]
    df = frame(spark, events, COLUMNS)
    got = failure_bursts(df, ["key"], "ts", "seq", F.col("kind") == "fail", "7 seconds", 2, "10 seconds")
    expect(got, brute(events, 7, 2))


@pytest.mark.parametrize("width", ["5 seconds", "11 seconds"])
def test_long_uneven_runs_are_chained_over_blocks(spark, monkeypatch, width):
    monkeypatch.setattr(bursts, "SLICES_PER_BLOCK", 3)
    events = random_events(12, 12, 150, ["fail"] * 60 + ["success"], gap=5, hot=400)
    df = frame(spark, events, COLUMNS)
    got = failure_bursts(df, ["key"], "ts", "seq", F.col("kind") == "fail", "5 seconds", 3, width)
    expect(got, brute(events, 5, 3))


def test_success_at_the_deadline_cancels(spark):
    shape = [(0, 1, "fail", 10), (1, 1, "fail", 11), (2, 1, "fail", 12), (3, 1, "success", 15), (4, 1, "fail", 16)]
    df = frame(spark, shape, COLUMNS)
    failed = F.col("kind") == "fail"
    assert failure_bursts(df, ["key"], "ts", "seq", failed, "5 seconds", 3).count() == 0
    expect(failure_bursts(df, ["key"], "ts", "seq", failed, "4 seconds", 3), [(1, at(10), 0, at(12), 3)])


def test_keys_may_be_null_or_composite(spark):
    rows = [(i, None if i % 2 else "u", 1, "fail", 100 + i) for i in range(8)]
    df = frame(spark, rows, "seq bigint, name string, part int, kind string, ts timestamp_ntz")
    got = failure_bursts(df, ["name", "part"], "ts", "seq", F.col("kind") == "fail", "20 seconds", 3)
    expect(got, [(None, 1, at(101), 1, at(107), 4), ("u", 1, at(100), 0, at(106), 4)])


def test_slice_shorter_than_a_burst_is_refused(spark):
    df = frame(spark, [(0, 1, "fail", 1)], COLUMNS)
    with pytest.raises(ValueError):
        failure_bursts(df, ["key"], "ts", "seq", F.col("kind") == "fail", "5 seconds", 3, "2 seconds")
