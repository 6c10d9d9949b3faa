from collections import Counter

import pytest

from tests.support import START, at, expect, frame, random_events, rows_of
from tidemark.operators import cap_outcomes, cap_warnings, sliding_counts, within_cap
from tidemark.plans import ad_click_warnings, ad_clicks_by_province, ad_clicks_passed

EVENTS = random_events(3, 20, 40, ["a", "b"], gap=7000, hot=200)


def brute(cap):
    counts, out = Counter(), {}
    for second, seq, key, kind in sorted((s, q, k, e) for q, k, e, s in EVENTS):
        day = (second + 8 * 3600) // 86400
        counts[(key, kind, day)] += 1
        rank = counts[(key, kind, day)]
        out[seq] = (rank, "pass" if rank <= cap else "warn" if rank == cap + 1 else "drop")
    return out


@pytest.mark.parametrize("cap", [1, 4])
def test_cap_equals_counter(spark, cap):
    df = frame(spark, EVENTS, "seq bigint, key bigint, kind string, ts timestamp_ntz")
    want = brute(cap)
    got = cap_outcomes(df, ["key", "kind"], "ts", "seq", cap, piece="10 minutes")
    assert {r.seq: (r.day_rank, r.outcome) for r in got.collect()} == want
    passed = {r.seq for r in within_cap(df, ["key", "kind"], "ts", "seq", cap).collect()}
    assert passed == {s for s, (_, o) in want.items() if o == "pass"}
    warned = {r.first_over_seq for r in cap_warnings(df, ["key", "kind"], "ts", "seq", cap).collect()}
    assert warned == {s for s, (_, o) in want.items() if o == "warn"}


@pytest.mark.parametrize("piece", ["1 second", "10 minutes", "2 days"])
def test_cap_has_one_plan_at_any_width_and_limit(spark, piece):
    df = frame(spark, EVENTS, "seq bigint, key bigint, kind string, ts timestamp_ntz")
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    plain = rows_of(within_cap(df, ["key"], "ts", "seq", 5, piece=piece))
    assert plain == rows_of(within_cap(df, ["key"], "ts", "seq", 5))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        assert rows_of(within_cap(df, ["key"], "ts", "seq", 5, piece=piece)) == plain
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)


def test_cap_above_a_thousand_and_rows_without_a_time(spark):
    rows = [(0, i, at(START + i)) for i in range(1500)] + [(0, 5000 + i, None) for i in range(1200)]
    df = spark.createDataFrame(rows, "key bigint, seq bigint, ts timestamp_ntz")
    kept = {r.seq for r in within_cap(df, ["key"], "ts", "seq", 1100, piece="1 minute").collect()}
    assert kept == {*range(1100), *range(5000, 6100)}


def test_cap_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, at(1)), (None, 2, at(2)), (7, 3, at(3))], "key bigint, seq bigint, ts timestamp_ntz")
    got = cap_outcomes(df, ["key"], "ts", "seq", 1)
    assert {r.seq: (r.key, r.outcome) for r in got.collect()} == {1: (None, "pass"), 2: (None, "warn"), 3: (7, "pass")}


def test_hot_pair_is_capped_and_province_counts_follow(spark):
    """Somebody clicks one ad ten times more than the cap allows; others click here and there."""
    hot = [(i, 5, 80, "region 1", START + 20 * i + 1) for i in range(110)]
    other = [(200 + i, 10 + i, 81 + i % 2, f"region {2 + i % 3}", START + 90 * i + 2) for i in range(15)]
    clicks = frame(spark, hot + other, "event_id bigint, user_id bigint, ad_id bigint, province string, ts timestamp_ntz")
    assert ad_clicks_passed(clicks, "event_id").count() == 115
    warnings = ad_click_warnings(clicks, "event_id").collect()
    assert [(w.user_id, w.ad_id, w.cap, w.first_over_ts) for w in warnings] == [(5, 80, 100, at(START + 2001))]
    counts = ad_clicks_by_province(clicks, "event_id").collect()
    assert sum(r.cnt for r in counts) == 115 * 720
    assert min(r.window_end for r in counts) == at(START + 5)
    assert max(r.cnt for r in counts if r.province == "region 1") == 100


def test_rank_order_within_the_day_does_not_depend_on_input_order(spark):
    df = frame(spark, EVENTS, "seq bigint, key bigint, kind string, ts timestamp_ntz")
    back = frame(spark, EVENTS[::-1], "seq bigint, key bigint, kind string, ts timestamp_ntz")
    assert rows_of(cap_outcomes(df, ["key"], "ts", "seq", 2)) == rows_of(cap_outcomes(back, ["key"], "ts", "seq", 2))


def test_counts_after_cap_do_not_exceed_counts_before(spark):
    df = frame(spark, EVENTS, "seq bigint, key bigint, kind string, ts timestamp_ntz")
    all_counts = {(r.key, r.window_end): r.cnt for r in sliding_counts(df, "ts", "1 day", "1 hour", ["key"]).collect()}
    capped = within_cap(df, ["key"], "ts", "seq", 3)
    for r in sliding_counts(capped, "ts", "1 day", "1 hour", ["key"]).collect():
        assert r.cnt <= all_counts[(r.key, r.window_end)]
