from collections import defaultdict

import pytest

from tests.support import at, expect, frame, random_events, rows_of
from tidemark.functions import poly_hash
from tidemark.operators import (
    approx_visitors,
    bitmap_visitors,
    exact_visitors,
    hashed_visitors,
    running_visitors,
    salted_counts,
    tumbling,
)

EVENTS = random_events(2, 80, 12, ["pv"], gap=900, hot=300)


@pytest.fixture(scope="module")
def events(spark):
    return frame(spark, EVENTS, "seq bigint, user_id bigint, kind string, ts timestamp_ntz").cache()


def seen_per_hour():
    hours = defaultdict(set)
    for _, user, _, second in EVENTS:
        hours[second // 3600].add(user)
    return hours


def test_exact_and_bitmap_visitors(events):
    want = [(at(h * 3600), at(h * 3600 + 3600), len(u)) for h, u in seen_per_hour().items()]
    expect(exact_visitors(events, "ts", "1 hour", "user_id"), want)
    expect(bitmap_visitors(events, "ts", "1 hour", "user_id"), want)
    expect(hashed_visitors(events, "ts", "1 hour", "user_id"), want)


def test_approx_visitors_are_close(events):
    exact = {tuple(r)[:2]: r.cnt for r in exact_visitors(events, "ts", "1 hour", "user_id").collect()}
    for r in approx_visitors(events, "ts", "1 hour", "user_id").collect():
        assert abs(r.cnt - exact[tuple(r)[:2]]) <= max(1, 0.05 * exact[tuple(r)[:2]])


def test_salted_counts_equal_plain_counts(events):
    assert rows_of(salted_counts(events, "ts", "1 hour", "seq")) == rows_of(tumbling(events, "ts", "1 hour"))
    plain = tumbling(events, "ts", "1 hour", ["user_id"])
    assert rows_of(salted_counts(events, "ts", "1 hour", "seq", ["user_id"], salts=7)) == rows_of(plain)


def test_running_visitors_count_up_to_the_exact_number(events):
    order = sorted((second, seq, user) for seq, user, _, second in EVENTS)
    seen, want = defaultdict(set), []
    for second, seq, user in order:
        hour = second // 3600
        if user not in seen[hour]:
            seen[hour].add(user)
            want.append((at(hour * 3600 + 3600), user, at(second), seq, len(seen[hour])))
    expect(running_visitors(events, "ts", "seq", "1 hour", "user_id"), want)


@pytest.mark.parametrize("bits", [1 << 29, 64])
def test_poly_hash(spark, bits):
    def plain(text):
        value = 0
        for c in text:
            value = value * 61 + ord(c)
        return value & (bits - 1)

    values = ["550077", "1", "", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(poly_hash("v", bits=bits)).collect()] == [plain(v) for v in values]
    with pytest.raises(ValueError):
        poly_hash("v", bits=100)
