from collections import defaultdict, deque
from datetime import date

import pytest

from tests.support import START, at, expect, frame, random_events, rows_of
from tidemark.operators import interval_join, interval_outer_join, reconcile
from tidemark.plans import payments_with_receipts, reconciled_payments

COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"


def sides(spark, events):
    df = frame(spark, events, COLUMNS)
    return df.where("kind = 'pay'").drop("kind"), df.where("kind = 'receipt'").drop("kind")


def brute_reconcile(events, pay_waits, receipt_waits):
    """First come first served, one queue per side, in time order."""
    groups = defaultdict(list)
    for seq, key, kind, second in events:
        groups[key].append((second, 0 if kind == "pay" else 1, seq))
    out = []
    for key, rows in groups.items():
        queues, waits = (deque(), deque()), (pay_waits, receipt_waits)

        def expire(now):
            for side in (0, 1):
                while queues[side] and queues[side][0][0] + waits[side] < now:
                    single(side, queues[side].popleft())

        def single(side, row):
            second, seq = row
            if side == 0:
                out.append((key, "single_pay", at(second), seq, None, None))
            else:
                out.append((key, "single_receipt", None, None, at(second), seq))

        for second, side, seq in sorted(rows):
            expire(second)
            if queues[1 - side]:
                other = queues[1 - side].popleft()
                pay, receipt = ((second, seq), other) if side == 0 else (other, (second, seq))
                out.append((key, "matched", at(pay[0]), pay[1], at(receipt[0]), receipt[1]))
            else:
                queues[side].append((second, seq))
        expire(1 << 60)
    return out


@pytest.mark.parametrize("slice", [None, "4 seconds"])
@pytest.mark.parametrize("gap,kinds", [(9, ["pay", "receipt"]), (3, ["pay", "receipt", "receipt"]), (2, ["pay", "pay", "receipt"])])
def test_reconcile_equals_two_queues(spark, gap, kinds, slice):
    events = random_events(7, 50, 20, kinds, gap=gap, hot=500)
    pays, receipts = sides(spark, events)
    got = reconcile(pays, receipts, ["key"], "ts", "ts", "seq", "seq", "5 seconds", "3 seconds", slice)
    expect(got, brute_reconcile(events, 5, 3))


@pytest.mark.parametrize("bucket", [None, "1 second", "1 hour"])
def test_interval_join(spark, bucket):
    events = random_events(8, 30, 12, ["pay", "receipt"], gap=9, hot=100)
    pays, receipts = sides(spark, events)
    p = [(k, s, q) for q, k, e, s in events if e == "pay"]
    r = [(k, s, q) for q, k, e, s in events if e == "receipt"]
    pairs = [(k, lq, at(ls), rq, at(rs)) for k, ls, lq in p for rk, rs, rq in r if k == rk and -3 <= rs - ls <= 5]
    got = interval_join(pays, receipts, ["key"], "ts", "ts", "3 seconds", "5 seconds", bucket)
    expect(got.select("key", "l_seq", "l_ts", "r_seq", "r_ts"), pairs)
    outer = interval_outer_join(pays, receipts, ["key"], "ts", "ts", "seq", "seq", "3 seconds", "5 seconds", bucket)
    met_l, met_r = {x[1] for x in pairs}, {x[3] for x in pairs}
    want = [(k, lq, rq, "matched") for k, lq, _, rq, _ in pairs]
    want += [(k, q, None, "single_pay") for k, _, q in p if q not in met_l]
    want += [(k, None, q, "single_receipt") for k, _, q in r if q not in met_r]
    expect(outer.select("key", "l_seq", "r_seq", "outcome"), want)


def test_transactions_at_the_bounds(spark):
    """A payment answered at either bound, one a second outside each, one twice answered, one never; a receipt of nobody."""
    pays = [(0, "low", START), (1, "high", START), (2, "before", START + 9), (3, "after", START + 9), (4, "twice", START), (5, "none", START), (6, "", START)]
    receipts = [
        (0, "low", START - 3), (1, "high", START + 5), (2, "before", START + 5), (3, "after", START + 15), (4, "twice", START + 1),
        (5, "twice", START + 2), (6, "lost", START),
    ]
    columns = "event_id bigint, tx_id string, ts timestamp_ntz"
    o, r = frame(spark, pays, columns), frame(spark, receipts, columns)
    assert rows_of(payments_with_receipts(o, r).select("tx_id")) == [("high",), ("low",), ("twice",), ("twice",)]
    expect(
        reconciled_payments(o, r, "event_id").select("tx_id", "outcome"),
        [(t, "matched") for t in ("low", "high", "twice")]
        + [(t, "single_pay") for t in ("before", "after", "none")]
        + [(t, "single_receipt") for t in ("before", "after", "twice", "lost")],
    )


PATCHY = "key bigint, seq bigint, ts timestamp_ntz"


def patchy_sides(spark):
    left = [(1, 1, at(10)), (1, 1, at(10)), (None, 2, at(10)), (2, 3, None), (3, None, at(10)), (3, None, at(10)), (4, 7, at(10)), (4, 7, at(10)), (None, None, None)]
    right = [(None, 2, at(10)), (2, 3, None), (3, 5, at(11)), (9, 1, at(1)), (9, 1, at(1)), (4, 8, at(12))]
    return spark.createDataFrame(left, PATCHY), spark.createDataFrame(right, PATCHY)


def test_reconcile_keeps_rows_that_lack_a_key_time_or_number(spark):
    left, right = patchy_sides(spark)
    rows = reconcile(left, right, ["key"], "ts", "ts", "seq", "seq", "5 seconds", "3 seconds").collect()
    outcomes = sorted((str(r.key), r.outcome) for r in rows)
    assert outcomes == sorted(
        [("1", "single_pay")] * 2 + [("None", "single_pay")] * 2 + [("None", "single_receipt"), ("2", "single_pay"), ("2", "single_receipt")]
        + [("3", "matched"), ("3", "single_pay"), ("4", "matched"), ("4", "single_pay")] + [("9", "single_receipt")] * 2
    )


@pytest.mark.parametrize("bucket", [None, "1 second"])
def test_outer_join_keeps_rows_that_lack_a_key_time_or_number(spark, bucket):
    left, right = patchy_sides(spark)
    rows = interval_outer_join(left, right, ["key"], "ts", "ts", "seq", "seq", "3 seconds", "5 seconds", bucket).collect()
    outcomes = sorted((str(r.key), r.outcome) for r in rows)
    assert outcomes == sorted(
        [("1", "single_pay")] * 2 + [("None", "single_pay")] * 2 + [("None", "single_receipt"), ("2", "single_pay"), ("2", "single_receipt")]
        + [("3", "matched")] * 2 + [("4", "matched")] * 2 + [("9", "single_receipt")] * 2
    )


def test_keys_may_be_named_like_sides_and_times_be_dates(spark):
    left = spark.createDataFrame([(1, date(2024, 1, 1), 5)], "l_key bigint, day date, seq bigint")
    right = spark.createDataFrame([(1, date(2024, 1, 3), 6), (2, date(2024, 1, 3), 7)], "l_key bigint, day date, seq bigint")
    got = interval_outer_join(left, right, ["l_key"], "day", "day", "seq", "seq", "1 day", "2 days")
    assert rows_of(got.select("l_key", "l_seq", "r_seq", "outcome")) == [(1, 5, 6, "matched"), (2, None, 7, "single_receipt")]
    single = reconcile(left, right, ["l_key"], "day", "day", "seq", "seq", "1 day", "1 day").orderBy("pay_ts").collect()
    assert {(r.l_key, r.outcome, r.pay_ts) for r in single if r.pay_ts} == {(1, "single_pay", date(2024, 1, 1))}
