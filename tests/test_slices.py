from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.support import START, expect, frame, random_events, rows_of
from tidemark.operators import consecutive_hits, fitting_width
from tidemark.operators.slices import hide_nulls, running_rank, show_nulls, slice_width, with_halo

COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"
EVENTS = random_events(13, 5, 30, ["a", "b"], gap=9, hot=300)


def test_fitting_width_bounds_every_slice(spark):
    df = frame(spark, EVENTS, COLUMNS)
    width = fitting_width(df, ["key"], "ts", widest="1 day", narrowest="1 second", max_rows=40)
    assert timedelta(seconds=1) < width < timedelta(days=1)
    us = int(width.total_seconds() * 1_000_000)
    assert max(Counter((k, s * 1_000_000 // us) for _, k, _, s in EVENTS).values()) <= 40
    assert fitting_width(df, ["key"], "ts", "1 day", max_rows=10_000) == timedelta(days=1)
    assert fitting_width(df, ["key"], "ts", "1 day", "3 seconds", max_rows=1) == timedelta(seconds=3)
    failed = F.col("kind") == "a"
    assert rows_of(consecutive_hits(df, ["key"], "ts", "seq", failed, 2, "5 seconds", slice=width)) == rows_of(
        consecutive_hits(df, ["key"], "ts", "seq", failed, 2, "5 seconds")
    )


def test_fitting_width_splits_a_dense_moment(spark):
    dense = [(i, 1, "a", START + i / 1000) for i in range(500)] + [(500 + i, 1, "a", START + 3600 * i) for i in range(9)]
    width = fitting_width(frame(spark, dense, COLUMNS), ["key"], "ts", "1 day", max_rows=50)
    assert width <= timedelta(milliseconds=50)


def test_default_width():
    minute, day = 60_000_000, 86_400_000_000
    assert slice_width(15 * minute, None) == 240 * minute
    assert slice_width(6 * 60 * minute, None) == day
    assert slice_width(3 * day, None) == 6 * day
    assert slice_width(day, "1 minute") == minute


@pytest.mark.parametrize("back,ahead", [(0, 0), (7, 0), (0, 12), (7, 12)])
def test_halo_shows_each_slice_what_is_in_reach(spark, back, ahead):
    times, width = [-3, 0, 4, 5, 9, 10, 11, 24], 5
    df = spark.createDataFrame([(t,) for t in times], "us bigint")
    want = [
        (t, s, t // width == s)
        for t in times
        for s in range(-10, 20)
        if s * width - back <= t and (t < (s + 1) * width or t - ahead < (s + 1) * width)
    ]
    expect(with_halo(df, "us", width, back, ahead), want)


def test_running_rank_equals_row_number_and_keeps_nulls(spark):
    rows = [(k, s // 7 if s % 5 else None, s if s % 5 else None, q) for q, k, _, s in EVENTS] + [(None, 1, 1, -1), (None, 2, 2, -2)]
    df = spark.createDataFrame(rows, "key bigint, piece bigint, at bigint, seq bigint")
    want = df.selectExpr("*", "cast(row_number() over (partition by key order by at, seq) as bigint) as rank")
    assert rows_of(running_rank(df, ["key"], "piece", ["at", "seq"])) == rows_of(want)


def test_nulls_are_hidden_and_shown(spark):
    df = spark.createDataFrame([(None, None, 1), ("", 0, 2), ("x", None, 3)], "name string, n int, v int")
    hidden, full = hide_nulls(df, ["name", "n"])
    assert hidden.select(*full).distinct().count() == 3
    assert hidden.where("name is null or n is null").count() == 0
    assert rows_of(show_nulls(hidden, ["name", "n"]).select("name", "n", "v")) == rows_of(df)
    with pytest.raises(TypeError):
        hide_nulls(df.withColumn("a", F.array("n")), ["a"])
