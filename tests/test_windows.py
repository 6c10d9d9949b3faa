from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.support import START, at, expect, frame, random_events, rows_of
from tidemark import operators as ops
from tidemark.operators import ranking_report, sliding_counts, sliding_direct, sliding_merge, top_n, top_n_sql, tumbling

EVENTS = random_events(1, 6, 60, ["a", "b"], gap=400, hot=400)


@pytest.fixture(scope="module")
def events(spark):
    return frame(spark, EVENTS, "seq bigint, key bigint, kind string, ts timestamp_ntz").cache()


def brute_sliding(size, slide):
    counts = Counter()
    for _, key, _, second in EVENTS:
        i = second // slide
        while i * slide > second - size:
            counts[(key, i)] += 1
            i -= 1
    return [(k, at(i * slide), at(i * slide + size), n) for (k, i), n in counts.items()]


@pytest.mark.parametrize("size,slide", [(60, 5), (3600, 300), (60, 25), (10, 25), (30, 30)])
@pytest.mark.parametrize("per_slice", [None, 3])
def test_sliding_counts_equal_brute_force(events, size, slide, per_slice):
    got = sliding_counts(events, "ts", f"{size} seconds", f"{slide} seconds", ["key"], windows_per_slice=per_slice)
    expect(got, brute_sliding(size, slide))


def test_sliding_counts_equal_direct_windows(events):
    fast = sliding_counts(events, "ts", "60 seconds", "5 seconds", ["key", "kind"])
    direct = sliding_direct(events, "ts", "60 seconds", "5 seconds", ["key", "kind"])
    assert rows_of(fast) == rows_of(direct)


def test_sliding_merge_handles_other_aggregates(events):
    partials = [F.min("seq").alias("lo"), F.max("seq").alias("hi")]
    merges = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    direct = sliding_direct(events, "ts", "60 seconds", "25 seconds", ["key"], partials)
    assert rows_of(sliding_merge(events, "ts", "60 seconds", "25 seconds", ["key"], partials, merges)) == rows_of(direct)


def test_sliding_counts_keep_null_keys_and_drop_null_times(spark):
    df = spark.createDataFrame([(None, at(1)), (None, at(2)), (1, None)], "key bigint, ts timestamp_ntz")
    expect(sliding_counts(df, "ts", "10 seconds", "10 seconds", ["key"]), [(None, at(0), at(10), 2)])


def test_sliding_counts_before_1970(spark):
    df = spark.createDataFrame([(1, at(-1)), (1, at(1))], "key bigint, ts timestamp_ntz")
    expect(
        sliding_counts(df, "ts", "10 seconds", "5 seconds", ["key"]),
        [(1, at(-10), at(0), 1), (1, at(-5), at(5), 2), (1, at(0), at(10), 1)],
    )


def test_tumbling_without_key_and_with_other_zone(spark, events):
    zone = spark.conf.get("spark.sql.session.timeZone")
    utc = rows_of(tumbling(events, "ts", "1 minute"))
    counts = Counter(s // 60 for _, _, _, s in EVENTS)
    assert utc == sorted([(at(m * 60), at(m * 60 + 60), n) for m, n in counts.items()], key=repr)
    utc_sliding = rows_of(sliding_counts(events, "ts", "60 seconds", "5 seconds"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows_of(tumbling(events, "ts", "1 minute")) == utc
        assert rows_of(sliding_counts(events, "ts", "60 seconds", "5 seconds")) == utc_sliding
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_top_n_breaks_ties_by_key_and_equals_sql(spark):
    rows = [(at(START), "b", 2), (at(START), "a", 2), (at(START), "c", 3), (at(START), "d", 1), (at(START + 1), "d", 1)]
    counts = spark.createDataFrame(rows, "window_end timestamp_ntz, url string, cnt bigint")
    top = top_n(counts, 2, ["url"])
    expect(top, [(at(START), "c", 3, 1), (at(START), "a", 2, 2), (at(START + 1), "d", 1, 1)])
    counts.createOrReplaceTempView("tie_counts")
    assert rows_of(top_n_sql(spark, "tie_counts", 2, "url")) == rows_of(top)
    report = ranking_report(top, F.format_string("%d) %s", "row_num", "url")).orderBy("window_end").collect()
    assert report[0].report == "window end 2017-11-26 01:00:00\n1) c\n2) a"


def test_top_n_is_limited_before_the_shuffle(events):
    plan = top_n(sliding_counts(events, "ts", "60 seconds", "5 seconds", ["key"]), 3, ["key"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(("size", "slide"), [("20 seconds", "5 seconds"), ("7 seconds", "3 seconds"), ("4 seconds", "4 seconds"), ("10 seconds", "4 seconds")])
def test_two_merges_give_every_window(spark, size, slide):
    df = frame(spark, random_events(3, 4, 40, ["a"], gap=23, hot=50), "seq bigint, key bigint, kind string, ts timestamp_ntz")
    partials = {"low": F.min("seq"), "high": F.max("seq"), "n": F.count("*")}
    merges = {"low": F.min, "high": F.max, "n": F.sum}
    got = ops.sliding_aggregate(df, "ts", size, slide, ["key"], partials, merges)
    want = ops.sliding_merge(
        df, "ts", size, slide, ["key"], [c.alias(f"_{n}") for n, c in partials.items()], [merges[n](f"_{n}").alias(n) for n in merges]
    )
    assert rows_of(got) == rows_of(want)
    early, late = df.where("seq % 2 = 0"), df.where("seq % 2 = 1")
    stored = [ops.pane_values(part, "ts", size, slide, ["key"], partials) for part in (early, late)]
    assert rows_of(ops.windows_of_panes(stored[0].unionByName(stored[1]), size, slide, ["key"], merges)) == rows_of(want)
