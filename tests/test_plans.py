"""Shapes of the physical plans: what reaches the scan, how often data is shuffled, what must not appear."""

import re

import pytest
from pyspark.sql import functions as F

from tests.support import START, frame
from tidemark import plans
from tidemark.operators import Pattern, classify_lateness, consecutive_hits, interval_join, match, within_cap
from workload.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def behavior(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("behavior") / "table")
    rows = [(i, i % 7, i % 5, 1, ["pv", "buy"][i % 2], START + 40 * i) for i in range(200)]
    columns = "event_id bigint, user_id bigint, item_id bigint, category_id int, behavior string, ts timestamp_ntz"
    frame(spark, rows, columns).write.parquet(path)
    return spark.read.parquet(path)


def test_filter_and_columns_reach_the_scan(behavior):
    text = plan(plans.hot_items(behavior))
    assert "EqualTo(behavior,pv)" in text
    assert "ReadSchema: struct<item_id:bigint,behavior:string,ts:timestamp_ntz>" in text


def test_shuffle_counts(behavior):
    hit = F.col("behavior") == "buy"
    assert exchanges(consecutive_hits(behavior, ["user_id"], "ts", "event_id", hit, 3, "5 seconds")) == 1
    pattern = Pattern.begin("a", hit).followed_by("b", ~hit).followed_by("c", hit).within("5 minutes")
    assert exchanges(match(behavior, ["user_id"], "ts", "event_id", pattern)) == 1
    # The rows left of each piece, the counts of the pieces, and their sums before each piece.
    assert exchanges(within_cap(behavior, ["user_id"], "ts", "event_id", 2)) == 3
    assert exchanges(plans.page_view_totals(behavior)) == 1
    # Counting per pane, spreading the changes, ranking.
    assert exchanges(plans.hot_items(behavior)) == 3


def test_limits_are_applied_before_the_shuffle(behavior):
    assert plan(within_cap(behavior, ["user_id"], "ts", "event_id", 2)).count("WindowGroupLimit") == 2
    assert plan(plans.hot_items(behavior)).count("WindowGroupLimit") == 2


def test_hot_keys_are_joined_by_time_bucket(spark, behavior):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = interval_join(behavior, behavior, ["user_id"], "ts", "ts", "3 seconds", "5 seconds")
        assert "hashpartitioning(user_id" in plan(joined) and "_bucket" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream")])
def test_no_query_pairs_everything_with_everything(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_lateness_has_no_single_task_over_chunks(spark, behavior):
    classified = classify_lateness(behavior, "ts", "event_id", "3 seconds", "1 minute", "10 minutes", chunk_rows=2)
    text = plan(classified)
    assert len(re.findall(r"Exchange SinglePartition", text)) == 1 and "hashpartitioning(_group" in text
