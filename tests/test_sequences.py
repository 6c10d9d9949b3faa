import pytest
from pyspark.sql import functions as F

from tests.support import START, at, by_key, expect, frame, random_events, rows_of
from tidemark.operators import Pattern, adjacent_pairs_by_arrival, consecutive_hits, match, open_close_outcomes

KINDS = ["fail", "fail", "success"]
EVENTS = random_events(4, 60, 25, KINDS, gap=9, hot=300)
STEPS = random_events(5, 60, 25, ["a", "b", "c"], gap=9, hot=300)
COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"


def failed():
    return F.col("kind") == "fail"


@pytest.fixture(scope="module")
def events(spark):
    return frame(spark, EVENTS, COLUMNS).cache()


@pytest.fixture(scope="module")
def steps(spark):
    return frame(spark, STEPS, COLUMNS).cache()


@pytest.mark.parametrize("slice", [None, "3 seconds", "1 hour"])
@pytest.mark.parametrize("n,within,inclusive", [(3, 5, False), (2, 2, True), (1, 1, False)])
def test_consecutive_hits(events, n, within, inclusive, slice):
    want = []
    for key, rows in by_key(EVENTS).items():
        for i in range(n - 1, len(rows)):
            run = rows[i - n + 1 : i + 1]
            gap = run[-1][0] - run[0][0]
            if all(r[2] == "fail" for r in run) and (gap <= within if inclusive else gap < within):
                want.append((key, at(run[0][0]), at(run[-1][0]), run[0][1], run[-1][1]))
    got = consecutive_hits(events, ["key"], "ts", "seq", failed(), n, f"{within} seconds", inclusive, slice)
    expect(got, want)


@pytest.mark.parametrize("chunk", [7, 5_000_000])
def test_adjacent_pairs_by_arrival(events, chunk):
    want, last = [], {}
    for seq, key, kind, second in EVENTS:
        previous = last.get(key)
        if previous and previous[2] == "fail" and kind == "fail" and second - previous[0] <= 2:
            want.append((key, at(previous[0]), at(second), previous[1], seq))
        last[key] = (second, seq, kind)
    expect(adjacent_pairs_by_arrival(events, ["key"], "ts", "seq", failed(), "2 seconds", chunk), want)


def brute_match(events, stages, within):
    """Follow every begin row through the stages; stages are (name, kind, strict)."""
    out = []
    for key, rows in by_key(events).items():
        for i, start in enumerate(rows):
            if start[2] != stages[0][1]:
                continue
            found, at_row, outcome = [start], i, None
            for _, kind, strict in stages[1:]:
                outcome = "timeout"
                for j in range(at_row + 1, len(rows)):
                    if rows[j][0] - start[0] >= within:
                        break
                    if rows[j][2] == kind:
                        found.append(rows[j])
                        at_row, outcome = j, "matched"
                        break
                    if strict:
                        outcome = None
                        break
                if outcome != "matched":
                    break
            if outcome:
                cells = []
                for k in range(len(stages)):
                    cells += [at(found[k][0]), found[k][1]] if k < len(found) else [None, None]
                end = found[-1][0] if outcome == "matched" else start[0] + within
                out.append((key, *cells, outcome, at(end)))
    return out


CASES = {
    "a then b": [("x", "a", False), ("y", "b", False)],
    "a then b then c": [("x", "a", False), ("y", "b", False), ("z", "c", False)],
    "a next b then c": [("x", "a", False), ("y", "b", True), ("z", "c", False)],
    "a then b next c": [("x", "a", False), ("y", "b", False), ("z", "c", True)],
    "a next a next a": [("x", "a", False), ("y", "a", True), ("z", "a", True)],
}


@pytest.mark.parametrize("slice", [None, "4 seconds"])
@pytest.mark.parametrize("case", CASES)
def test_pattern(steps, case, slice):
    stages = CASES[case]
    pattern = Pattern.begin(stages[0][0], F.col("kind") == stages[0][1])
    for name, kind, strict in stages[1:]:
        add = pattern.next if strict else pattern.followed_by
        pattern = add(name, F.col("kind") == kind)
    got = match(steps, ["key"], "ts", "seq", pattern.within("12 seconds"), slice)
    expect(got, brute_match(STEPS, stages, 12))


def test_times_expands_to_strict_stages(events):
    pattern = Pattern.begin("fail", failed()).times(3, consecutive=True).within("5 seconds")
    got = match(events, ["key"], "ts", "seq", pattern).where("outcome = 'matched'")
    spans = got.select("key", F.col("fail_1_ts"), F.col("fail_3_ts"), "fail_1_seq", "fail_3_seq")
    assert rows_of(spans) == rows_of(consecutive_hits(events, ["key"], "ts", "seq", failed(), 3, "5 seconds"))


def test_where_narrows_and_within_is_required(steps):
    pattern = Pattern.begin("x", F.col("kind") == "a").where(F.col("seq") < 50)
    found = match(steps, ["key"], "ts", "seq", pattern.followed_by("y", F.col("kind") == "b").within("9 seconds"))
    assert found.where("x_seq >= 50").count() == 0 and found.count() > 0
    with pytest.raises(ValueError):
        match(steps, ["key"], "ts", "seq", pattern)


@pytest.mark.parametrize("slice", [None, "5 seconds"])
def test_open_close_outcomes(steps, slice):
    want = []
    for key, rows in by_key(STEPS).items():
        rows = sorted((s, 0 if k == "a" else 1, q) for s, q, k in rows if k in "ab")
        for i, (second, close, seq) in enumerate(rows):
            following = rows[i + 1] if i + 1 < len(rows) else None
            if close and (i == 0 or rows[i - 1][1]):
                want.append((key, "orphan_pay", None, None, at(second), seq, at(second)))
            elif not close and following and following[1]:
                kind = "paid" if following[0] - second < 6 else "paid_late"
                want.append((key, kind, at(second), seq, at(following[0]), following[2], at(following[0])))
            elif not close:
                want.append((key, "timeout", at(second), seq, None, None, at(second + 6)))
    kind = F.col("kind")
    got = open_close_outcomes(steps, ["key"], "ts", "seq", kind == "a", kind == "b", "6 seconds", slice)
    expect(got, want)


def test_event_order_counts_and_arrival_order_does_not(spark):
    """Fails at 10, 11 and 12 that arrive mixed with a success of second 13; another key never fails twice."""
    rows = [(0, 1, "fail", 12), (1, 1, "success", 13), (2, 1, "fail", 10), (3, 2, "fail", 11), (4, 1, "success", 30), (5, 1, "fail", 11)]
    df = frame(spark, rows, COLUMNS)
    triples = consecutive_hits(df, ["key"], "ts", "seq", failed(), 3, "5 seconds")
    expect(triples.select("key", "first_ts", "last_ts"), [(1, at(10), at(12))])
    pairs = consecutive_hits(df, ["key"], "ts", "seq", failed(), 2, "1 second", inclusive=True)
    expect(pairs.select("key", "first_ts", "last_ts"), [(1, at(10), at(11)), (1, at(11), at(12))])
    assert adjacent_pairs_by_arrival(df, ["key"], "ts", "seq", failed(), "2 seconds").count() == 0


def test_five_fates_of_an_order(spark):
    """Paid early, paid in the same second by an earlier row, paid too late, never paid, never created."""
    rows = [
        (0, 1, "create", START), (1, 1, "pay", START + 100), (2, 2, "pay", START + 7), (3, 2, "create", START + 7),
        (4, 3, "create", START), (5, 3, "pay", START + 901), (6, 4, "create", START + 3), (7, 5, "pay", START),
    ]
    df = frame(spark, rows, COLUMNS)
    kind = F.col("kind")
    outcomes = open_close_outcomes(df, ["key"], "ts", "seq", kind == "create", kind == "pay", "15 minutes")
    expect(outcomes.select("key", "outcome"), [(1, "paid"), (2, "paid"), (3, "paid_late"), (4, "timeout"), (5, "orphan_pay")])
    pattern = Pattern.begin("create", kind == "create").followed_by("pay", kind == "pay").within("15 minutes")
    timeouts = match(df, ["key"], "ts", "seq", pattern).where("outcome = 'timeout'").select("key", "at")
    # By sequence number the pay of order 2 precedes its create in the same second.
    expect(timeouts, [(2, at(START + 907)), (3, at(START + 900)), (4, at(START + 903))])


def test_where_after_times_narrows_every_repeat(spark):
    df = frame(spark, [(i, 1, "fail", 10 + i) for i in range(6)], COLUMNS)
    pattern = Pattern.begin("f", failed()).times(3).where(F.col("seq") >= 2).within("9 seconds")
    got = match(df, ["key"], "ts", "seq", pattern).where("outcome = 'matched'").select("f_1_seq", "f_2_seq", "f_3_seq")
    expect(got, [(2, 3, 4), (3, 4, 5)])


def test_unknown_conditions_and_times_take_no_part(spark):
    rows = [(0, 1, "a", at(1)), (1, 1, "b", at(2)), (2, 1, None, at(3)), (3, 2, "a", None), (4, 2, "b", at(9))]
    df = spark.createDataFrame(rows, "seq bigint, key bigint, kind string, ts timestamp_ntz")
    opens, closes = F.col("kind") == "a", F.col("kind").isin("b") | F.col("kind").isNull()
    got = open_close_outcomes(df, ["key"], "ts", "seq", opens, closes, "6 seconds").select("key", "outcome", "open_seq", "close_seq")
    expect(got, [(1, "paid", 0, 1), (1, "orphan_pay", None, 2), (2, "orphan_pay", None, 4)])
