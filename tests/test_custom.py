"""Aggregates of one's own against plain Python."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.support import at, expect, frame, random_events
from tidemark import operators as ops
from tidemark.operators import custom

EVENTS = random_events(21, 6, 50, ["a", "b", "c"], gap=23, hot=300)
COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"


class Spread(ops.Aggregate):
    """Kinds seen and the two largest sequence numbers."""

    inputs = ("kind", "seq")
    state = "kinds array<string>, best array<bigint>, n bigint"
    result = "kinds string, second bigint, n bigint"

    def zero(self):
        return [], [], 0

    def add(self, state, rows):
        seen = [k for k in rows["kind"].unique().to_pylist() if k is not None]
        return self.merge(state, (seen, np.sort(rows["seq"].to_numpy())[-2:].tolist(), rows.num_rows))

    def merge(self, one, other):
        return sorted({*one[0], *other[0]}), sorted([*one[1], *other[1]])[-2:], one[2] + other[2]

    def finish(self, state):
        return "".join(state[0]), state[1][0] if len(state[1]) == 2 else None, state[2]


def finished(rows):
    kinds, numbers = "".join(sorted({k for k, _ in rows if k})), sorted(s for _, s in rows)
    return kinds, numbers[-2] if len(numbers) > 1 else None, len(rows)


@pytest.mark.parametrize("held", [2, 50_000])
def test_per_key(spark, monkeypatch, held):
    monkeypatch.setattr(custom, "HELD_KEYS", held)
    monkeypatch.setattr(custom, "BATCH_ROWS", 3)
    events = [*EVENTS, (90_001, None, "a", 5), (90_002, None, None, None)]
    df = spark.createDataFrame([(s, k, d, None if t is None else at(t)) for s, k, d, t in events], COLUMNS).repartition(7)
    groups = defaultdict(list)
    for seq, key, kind, _ in events:
        groups[key].append((kind, seq))
    expect(ops.custom_aggregate(df, ["key"], Spread()), [(k, *finished(v)) for k, v in groups.items()])
    everything = [pair for group in groups.values() for pair in group]
    expect(ops.custom_aggregate(df, [], Spread()), [finished(everything)])
    expect(ops.custom_aggregate(df.limit(0), [], Spread()), [])
    expect(ops.custom_aggregate(df.limit(0), ["key"], Spread()), [])


@pytest.mark.parametrize("size,slide", [(60, 5), (60, 25), (10, 25), (30, 30), (7, 3)])
@pytest.mark.parametrize("per_slice", [None, 3])
def test_per_sliding_window(spark, size, slide, per_slice):
    events = [(s, k, d, t - 1_511_658_030) for s, k, d, t in EVENTS]  # times on both sides of 1970
    groups = defaultdict(list)
    for seq, key, kind, second in events:
        i = second // slide
        while i * slide > second - size:
            groups[key, i].append((kind, seq))
            i -= 1
    df = frame(spark, events, COLUMNS).repartition(5)
    untimed = spark.createDataFrame([(1, 1, "z", None)], COLUMNS)
    got = ops.custom_sliding(df.unionByName(untimed), "ts", f"{size} seconds", f"{slide} seconds", ["key"], Spread(), per_slice)
    expect(got, [(k, at(i * slide), at(i * slide + size), *finished(rows)) for (k, i), rows in groups.items()])


def test_rows_shrink_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 4).select(F.lit("hot").alias("key"), F.col("id").alias("seq"), F.lit("a").alias("kind"))
    found = ops.custom_aggregate(df, ["key"], Spread())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.index("Exchange") < plan.rindex("MapInArrow")
    partials, _ = custom._partials(df, ["key"], Spread())
    assert partials.count() == 4
    expect(found, [("hot", "a", 99_998, 100_000)])


def test_fractional_keys_are_refused(spark):
    with pytest.raises(TypeError):
        ops.custom_aggregate(spark.range(3).selectExpr("id * 0.5D as key", "id as seq", "'a' as kind"), ["key"], Spread())
