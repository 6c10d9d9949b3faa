"""Registered queries: each runs one analysis over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import plans, schemas
from tidemark.functions import poly_hash
from tidemark.sources import parse_access_log, parse_lines
from tidemark.sources.lines import as_messages
from workload import roles
from workload.streams import STREAM_QUERIES, scratch

#: Sequence numbers per chunk in the lateness queries, so that even small tables have many chunks.
CHUNK = 100

Query = Callable[[SparkSession, str], DataFrame]


def item_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.item_view_counts(roles.behavior(spark, sf_dir))


def hot_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.hot_items(roles.behavior(spark, sf_dir))


def hot_items_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.hot_items_sql(roles.behavior(spark, sf_dir))


def ranking_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.format_string("no %d: item %d, %d views", "row_num", "item_id", "cnt")
    return ops.ranking_report(hot_items_topn(spark, sf_dir), line)


def page_flow_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.page_flow(roles.access(spark, sf_dir))


def page_flow_late_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.page_flow_with_lateness(roles.delayed_access(spark, sf_dir), "event_id", chunk_rows=CHUNK)


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.page_flow_late_rows(roles.delayed_access(spark, sf_dir), "event_id", chunk_rows=CHUNK)


def late_rows_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lateness of every request when some lack a time and some a place in the order."""
    rows = roles.patchy(roles.delayed_access(spark, sf_dir), "ts", 11)
    rows = rows.withColumn("request", F.col("event_id"))
    rows = roles.patchy(rows, "event_id", 13, by="request")
    classified = ops.classify_lateness(rows, "ts", "event_id", "3 seconds", "1 minute", "10 minutes", "5 seconds", CHUNK)
    return classified.select("request", "ts", "watermark", "is_late")


def page_view_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.page_view_totals(roles.behavior(spark, sf_dir))


def page_view_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.page_view_totals(roles.behavior(spark, sf_dir), seq="event_id")


def uv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.visitors(roles.behavior(spark, sf_dir), "exact")


def uv_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.visitors(roles.behavior(spark, sf_dir), "hashed")


def uv_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.visitors(roles.behavior(spark, sf_dir), "bitmap")


def uv_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per window the exact count, and whether the estimate lies within five hundredths (or one) of it."""
    behavior = roles.behavior(spark, sf_dir)
    exact = plans.visitors(behavior, "exact")
    estimated = plans.visitors(behavior, "approx").withColumnRenamed("cnt", "estimate")
    near = F.abs(F.col("estimate") - F.col("cnt")) <= F.greatest(F.lit(1.0), 0.05 * F.col("cnt"))
    return exact.join(estimated, "window_end").select("window_end", "cnt", near.alias("near"))


def uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = roles.behavior(spark, sf_dir).where(F.col("behavior") == "pv")
    return ops.running_visitors(views, "ts", "event_id", "1 hour", "user_id")


def uv_running_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = roles.behavior(spark, sf_dir).where(F.col("behavior") == "pv")
    return ops.running_visitors(views, "ts", "event_id", "1 hour", poly_hash("user_id"))


def value_range_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest, largest and number of values per event type in sliding days, merged from panes."""
    merged = ops.sliding_merge(
        roles.events(spark, sf_dir), "ts", "1 day", "1 hour", ["event_type"],
        [F.min("value").alias("_low"), F.max("value").alias("_high"), F.count("value").alias("_n")],
        [F.min("_low").alias("low"), F.max("_high").alias("high"), F.sum("_n").alias("n")],
    )
    return merged.drop("window_start")


def value_range_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest, largest and number of values per event type in hours that slide by five seconds: two merges a window."""
    found = ops.sliding_aggregate(
        roles.events(spark, sf_dir), "ts", "1 hour", "5 seconds", ["event_type"],
        {"low": F.min("value"), "high": F.max("value"), "n": F.count("value")}, {"low": F.min, "high": F.max, "n": F.sum},
    )
    return found.drop("window_start")


class RunnerUp(ops.Aggregate):
    """The two largest different values and by how much the first leads."""

    inputs = ("value",)
    state = "best array<double>"
    result = "best double, second double, lead double"

    def zero(self) -> tuple:
        return ([],)

    def add(self, state: tuple, rows: pa.Table) -> tuple:
        return self.merge(state, (np.unique(rows["value"].drop_null().to_numpy())[-2:].tolist(),))

    def merge(self, one: tuple, other: tuple) -> tuple:
        return (sorted({*one[0], *other[0]})[-2:],)

    def finish(self, state: tuple) -> tuple:
        second, best = [None, None, *state[0]][-2:]
        return best, second, None if second is None else best - second


def value_runner_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest values of an event type and hour, by an aggregate of its own."""
    rows = roles.events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return ops.custom_aggregate(rows, ["event_type", "hour"], RunnerUp())


def value_runner_up_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in days that slide by a quarter of an hour, 96 windows to a row."""
    found = ops.custom_sliding(roles.events(spark, sf_dir), "ts", "1 day", "15 minutes", ["event_type"], RunnerUp())
    return found.drop("window_start")


def uv_sliding_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors of days that slide by the hour, from hourly sketches written and read again: exact count, and whether the
    estimate lies within five hundredths (or one) of it."""
    views = roles.behavior(spark, sf_dir).where(F.col("behavior") == "pv")
    folder = scratch(spark)
    ops.pane_values(views, "ts", "1 day", "1 hour", [], {"sketch": F.hll_sketch_agg("user_id", F.lit(14))}).write.parquet(folder)
    stored = spark.read.parquet(folder)
    merged = ops.windows_of_panes(stored, "1 day", "1 hour", [], {"sketch": F.hll_union_agg})
    estimated = merged.select("window_end", F.hll_sketch_estimate("sketch").alias("estimate"))
    # The exact count, to compare with: users once per pane, then per window.
    sets = ops.sliding_merge(
        views, "ts", "1 day", "1 hour", ["user_id"], [F.count("*").alias("_n")], [F.sum("_n").alias("_n")]
    )
    exact = sets.groupBy("window_end").agg(F.count("*").alias("cnt"))
    near = F.abs(F.col("estimate") - F.col("cnt")) <= F.greatest(F.lit(1.0), 0.05 * F.col("cnt"))
    return exact.join(estimated, "window_end").select("window_end", "cnt", near.alias("near"))


def marketing_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.channel_behavior_counts(roles.marketing(spark, sf_dir), excluded="signup")


def click_cap_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ad_clicks_passed(roles.ad_clicks(spark, sf_dir), "event_id", cap=2)


def click_cap_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ad_click_warnings(roles.ad_clicks(spark, sf_dir), "event_id", cap=2)


def click_cap_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cap_outcomes(roles.ad_clicks(spark, sf_dir), ["user_id", "ad_id"], "ts", "event_id", cap=2)


def ad_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ad_clicks_by_province(
        roles.ad_clicks(spark, sf_dir), "event_id", cap=2, size="1 day", slide="2 minutes"
    )


def fail_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.failed_pairs(roles.logins(spark, sf_dir), "event_id", within="6 hours")


def fail_pairs_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival order, with every tenth event stepping back two hours."""
    early = F.when(F.pmod("event_id", F.lit(10)) == 0, F.col("ts") - F.expr("interval 2 hours")).otherwise(F.col("ts"))
    rows = roles.logins(spark, sf_dir).withColumn("ts", early)
    return plans.failed_pairs(rows, "event_id", within="6 hours", by_arrival=True)


def fail_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.failed_triples(roles.logins(spark, sf_dir), "event_id", within="1 day")


def fail_triples_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "fail"
    pattern = ops.Pattern.begin("fail", failed).times(3, consecutive=True).within("1 day")
    found = ops.match(roles.logins(spark, sf_dir), ["user_id"], "ts", "event_id", pattern)
    return found.where(F.col("outcome") == "matched").drop("outcome", "at")


def fail_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.failed_bursts(roles.logins(spark, sf_dir), "event_id", within="2 days")


def order_pay_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.order_payments(roles.orders(spark, sf_dir), "event_id", within="1 day")


def order_pay_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.order_outcomes(roles.orders(spark, sf_dir), "event_id", within="1 day")


def pattern_followed_by_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    pattern = (
        ops.Pattern.begin("signup", kind == "signup")
        .followed_by("view", kind == "view")
        .followed_by("purchase", kind == "purchase")
        .within("3 days")
    )
    return ops.match(roles.events(spark, sf_dir), ["user_id"], "ts", "event_id", pattern)


def pattern_next_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    pattern = (
        ops.Pattern.begin("view", kind == "view").next("click", kind == "click").followed_by("purchase", kind == "purchase")
    ).within("2 days")
    return ops.match(roles.events(spark, sf_dir), ["user_id"], "ts", "event_id", pattern)


def tx_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.payments_with_receipts(
        roles.payments(spark, sf_dir), roles.receipts(spark, sf_dir), before="3 hours", after="5 hours"
    )


def tx_interval_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    pays = roles.payments(spark, sf_dir).where(~F.col("tx_id").eqNullSafe(F.lit("")))
    return ops.interval_outer_join(
        pays, roles.receipts(spark, sf_dir), ["tx_id"], "ts", "ts", "event_id", "event_id", "3 hours", "5 hours"
    )


def tx_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.reconciled_payments(
        roles.payments(spark, sf_dir), roles.receipts(spark, sf_dir), "event_id",
        pay_waits="5 hours", receipt_waits="3 hours",
    )


def tx_reconcile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation when some payments and receipts lack an id and some a time."""
    pays = roles.payments(spark, sf_dir).where(F.col("tx_id") != "")
    pays, receipts = (
        roles.patchy(roles.patchy(side, "tx_id", 7), "ts", 11) for side in (pays, roles.receipts(spark, sf_dir))
    )
    return plans.reconciled_payments(pays, receipts, "event_id", pay_waits="5 hours", receipt_waits="3 hours")


def interval_join_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    lines = roles.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate"
    )
    joined = ops.interval_join(orders, lines, ["orderkey"], "o_orderdate", "l_shipdate", "3 days", "5 days")
    return joined.select(
        "orderkey",
        F.col("l_o_orderdate").alias("orderdate"),
        F.col("r_l_linenumber").alias("linenumber"),
        F.col("r_l_shipdate").alias("shipdate"),
    )


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(roles.log_lines(spark, sf_dir))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and other events written as lines, as a topic carries them, and parsed back."""
    rows = roles.events(spark, sf_dir)
    tx = F.when(F.col("event_type") == "purchase", F.format_string("tx-%d", "event_id")).otherwise("")
    written = rows.select("user_id", F.format_string(" %s ", "event_type").alias("event_type"), tx.alias("tx_id"), "ts")
    parsed = parse_lines(as_messages(written).select("value"), schemas.ORDER)
    return parsed.select("order_id", "event_type", "tx_id", F.unix_seconds("ts").alias("epoch_s"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        item_view_counts,
        hot_items_topn,
        hot_items_sql,
        ranking_report,
        page_flow_topn,
        page_flow_late_aware,
        late_rows,
        late_rows_nulls,
        page_view_hourly,
        page_view_salted,
        uv_exact,
        uv_hashed,
        uv_bitmap,
        uv_approx,
        value_range_sliding,
        value_range_fine,
        value_runner_up,
        value_runner_up_sliding,
        uv_sliding_sketch,
        uv_running,
        uv_running_hashed,
        marketing_by_channel,
        click_cap_pass,
        click_cap_warn,
        click_cap_outcomes,
        ad_by_province,
        fail_pairs,
        fail_pairs_arrival,
        fail_triples,
        fail_triples_pattern,
        fail_bursts,
        order_pay_pattern,
        order_pay_outcomes,
        pattern_followed_by_3,
        pattern_next_chain,
        tx_interval_join,
        tx_interval_outer,
        tx_reconcile,
        tx_reconcile_nulls,
        interval_join_orders,
        log_parse,
        csv_round_trip,
    )
} | STREAM_QUERIES
