"""Registered queries that run as streams: the events table replayed to its end, results read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import streaming
from tidemark.functions import micros
from tidemark.operators import Pattern
from tidemark.session import SETTINGS
from tidemark.streaming.wall_clock import NO_DATA_BATCHES

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
CLOSING = "closing"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"


def scratch(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder; a local session without one uses a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="stream-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/stream-{uuid.uuid4().hex}"


@contextmanager
def stream_settings(spark: SparkSession, empty_batches: bool = True) -> Iterator[None]:
    """State in RocksDB, one state partition per core."""
    before = {name: spark.conf.get(name, None) for name in (PROVIDER, PARTITIONS, NO_DATA_BATCHES)}
    spark.conf.set(PROVIDER, SETTINGS[PROVIDER])
    spark.conf.set(NO_DATA_BATCHES, str(empty_batches).lower())
    spark.conf.set(PARTITIONS, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def events(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events table as a stream, with one closing row far later that lets every window and timer end."""
    closing = [(1 << 60, datetime(2100, 1, 1), -1, CLOSING, 0.0, "{}")]
    spark.createDataFrame(closing, EVENTS).write.parquet(f"{folder}/closing")
    # A pattern, because a file stream takes the plain path of a single file for a folder.
    table = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")
    return table.unionByName(spark.readStream.schema(EVENTS).parquet(f"{folder}/closing"))


#: Rows of a file of a stretch, about.
FILE_ROWS = 1_000_000


def in_stretches(rows: DataFrame, stretch: Column, folder: str, pieces: int) -> DataFrame:
    """``rows`` as a stream that reads one stretch, numbered from 0, after the other, and a closing row at the end.

    Stretches, which should hold about equally many rows, lie in as many files as their size asks for; each trigger takes one.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("_stretch", stretch)
    largest = placed.groupBy("_stretch").count().agg(F.max("count")).first()[0] or 0
    files = max(1, -(-largest // FILE_ROWS))
    for k in range(pieces):
        placed.where(F.col("_stretch") == k).drop("_stretch").repartition(files).write.parquet(f"{folder}/events/{k}")
    closing = [(1 << 60, datetime(2100, 1, 1), -1, CLOSING, 0.0, "{}")]
    spark.createDataFrame(closing, EVENTS).coalesce(1).write.parquet(f"{folder}/events/{pieces}")
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", str(files)).parquet(f"{folder}/events/*")


def ordered_events(spark: SparkSession, sf_dir: str, folder: str, pieces: int = 3) -> DataFrame:
    """``events`` in several stretches of growing times, one per trigger, so that more than one batch has data."""
    rows = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    us = micros(rows, "ts")
    cuts = rows.select(us.alias("us")).approxQuantile("us", [k / pieces for k in range(1, pieces)], 0.001)
    stretch = sum((F.when(us > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    return in_stretches(rows, stretch, folder, pieces)


def finish(writer: DataStreamWriter, folder: str) -> None:
    writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def _zoneless(df: DataFrame) -> DataFrame:
    """Stream times back to zone-less ones, without regard to the session's zone."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return df.select(
        *[
            (start + F.unix_micros(c) * F.expr("interval '0.000001' second")).alias(c) if t == "timestamp" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def stream_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot items: chained panes, windows ranked as they close."""
    folder = scratch(spark)
    with stream_settings(spark):
        item = F.get_json_object("props", "$.k").cast("bigint")
        # The closing row has no item, and is kept until the windows are ranked.
        views = events(spark, sf_dir, folder).where(F.col("event_type").isin("view", CLOSING))
        counts = streaming.stream_counts(views.withColumn("item_id", item), "ts", "1 hour", "5 minutes", ["item_id"])
        finish(streaming.ranked_sink(counts, 5, ["item_id"], f"{folder}/top"), folder)
    top = spark.read.parquet(f"{folder}/top").where(F.col("item_id").isNotNull())
    return _zoneless(top.select("item_id", "window_end", "cnt", "row_num"))


def stream_hot_items_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot items: each window's best kept in list state until its end, a few rows per part of its items."""
    folder = scratch(spark)
    with stream_settings(spark):
        item = F.get_json_object("props", "$.k").cast("bigint")
        views = events(spark, sf_dir, folder).where(F.col("event_type").isin("view", CLOSING))
        counts = streaming.stream_counts(views.withColumn("item_id", item), "ts", "1 hour", "5 minutes", ["item_id"])
        best = streaming.stream_best_rows(counts, 5, ["item_id"])
        finish(streaming.ranked_sink(best, 5, ["item_id"], f"{folder}/top"), folder)
    top = spark.read.parquet(f"{folder}/top").where(F.col("item_id").isNotNull())
    return _zoneless(top.select("item_id", "window_end", "cnt", "row_num"))


def stream_uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each visitor's first view of the hour with the hour's visitors so far."""
    folder = scratch(spark)
    with stream_settings(spark):
        views = ordered_events(spark, sf_dir, folder).where(F.col("event_type").isin("view", CLOSING))
        running = streaming.stream_running_visitors(views, "ts", "event_id", "1 hour", "user_id")
        finish(streaming.changelog_sink(running, f"{folder}/running", mode="append"), folder)
    rows = spark.read.parquet(f"{folder}/running").where("window_end < timestamp'2099-01-01'").drop("_batch")
    return _zoneless(rows)


def stream_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly page views in update mode, kept as a changelog."""
    folder = scratch(spark)
    with stream_settings(spark):
        timed = streaming.event_time(events(spark, sf_dir, folder).where("event_type = 'view'"), "ts", "63 seconds")
        counts = timed.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("cnt"))
        changes = counts.select(F.col("w.end").alias("window_end"), "cnt")
        finish(streaming.changelog_sink(changes, f"{folder}/changes"), folder)
    return _zoneless(streaming.latest(spark, f"{folder}/changes", ["window_end"]))


def stream_order_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order outcomes from per-key state and timers."""
    folder = scratch(spark)
    with stream_settings(spark):
        rows = events(spark, sf_dir, folder).withColumnRenamed("user_id", "order_id")
        kind = F.col("event_type")
        outcomes = streaming.stream_open_close_outcomes(
            rows, ["order_id"], "ts", "event_id", kind == "signup", kind == "purchase", "1 day", patience="3650 days"
        )
        finish(streaming.changelog_sink(outcomes, f"{folder}/outcomes", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/outcomes").drop("_batch"))


def stream_fail_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure bursts from per-key state and timers."""
    folder = scratch(spark)
    with stream_settings(spark):
        bursts = streaming.stream_failure_bursts(
            events(spark, sf_dir, folder), ["user_id"], "ts", "event_id", F.col("event_type") == "error", "2 days", 3
        )
        finish(streaming.changelog_sink(bursts, f"{folder}/bursts", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/bursts").drop("_batch"))


def _hot_items_corrected(spark: SparkSession, sf_dir: str, log: bool) -> str:
    folder = scratch(spark)
    with stream_settings(spark):
        item = F.get_json_object("props", "$.k").cast("bigint")
        views = ordered_events(spark, sf_dir, folder).where("event_type = 'view'").withColumn("item_id", item)
        timed = streaming.event_time(views, "ts", "63 seconds")
        counts = timed.groupBy("item_id", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("cnt"))
        counts = counts.select("item_id", F.col("w.end").alias("window_end"), "cnt")
        finish(streaming.corrected_ranked_sink(counts, 5, ["item_id"], folder, "7 days", log=log), folder)
    return folder


def stream_hot_items_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot items ranked early and corrected as the counts grow; the final table."""
    folder = _hot_items_corrected(spark, sf_dir, log=False)
    return _zoneless(streaming.upserted(spark, f"{folder}/top").select("item_id", "window_end", "cnt", "row_num"))


def stream_hot_items_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot items from the log of their changes: what was put in and not taken back."""
    folder = _hot_items_corrected(spark, sf_dir, log=True)
    standing = streaming.net(streaming.retractions(spark, folder))
    return _zoneless(standing.select("item_id", "window_end", "cnt", "row_num"))


def stream_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct visitors per hour."""
    folder = scratch(spark)
    with stream_settings(spark):
        views = ordered_events(spark, sf_dir, folder).where(F.col("event_type").isin("view", CLOSING))
        counts = streaming.stream_visitors(views, "ts", "1 hour", "user_id")
        finish(streaming.changelog_sink(counts, f"{folder}/visitors", mode="append"), folder)
    found = spark.read.parquet(f"{folder}/visitors").where("window_end < timestamp'2099-01-01'")
    return _zoneless(found.select("window_end", "cnt"))


def stream_order_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every create with its first later pay, or a timeout."""
    folder = scratch(spark)
    with stream_settings(spark):
        rows = ordered_events(spark, sf_dir, folder).withColumnRenamed("user_id", "order_id")
        kind = F.col("event_type")
        paid = streaming.stream_followed_by(rows, ["order_id"], "ts", "event_id", kind == "signup", kind == "purchase", "1 day")
        finish(streaming.changelog_sink(paid, f"{folder}/paid", mode="append"), folder)
    names = {"open_ts": "create_ts", "open_seq": "create_seq", "close_ts": "pay_ts", "close_seq": "pay_seq"}
    return _zoneless(spark.read.parquet(f"{folder}/paid").drop("_batch").withColumnsRenamed(names))


def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and receipts matched one to one."""
    folder = scratch(spark)
    with stream_settings(spark):
        rows = ordered_events(spark, sf_dir, folder).withColumn("tx_id", F.col("user_id").cast("string"))
        # The closing row belongs to both sides, so that it moves both watermarks.
        pays, receipts = (rows.where(F.col("event_type").isin(kind, CLOSING)) for kind in ("purchase", "click"))
        met = streaming.stream_reconcile(pays, receipts, ["tx_id"], "ts", "event_id", "5 hours", "3 hours")
        finish(streaming.changelog_sink(met, f"{folder}/met", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/met").drop("_batch").where("tx_id <> '-1'"))


def stream_reconcile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and receipts matched when some lack an id and some a time."""
    folder = scratch(spark)
    with stream_settings(spark):
        rows = ordered_events(spark, sf_dir, folder).withColumn("tx_id", F.col("user_id").cast("string"))
        closing = F.col("event_type") == CLOSING
        for column, every in (("tx_id", 7), ("ts", 11)):
            missing = (F.pmod("event_id", F.lit(every)) == 0) & ~closing
            rows = rows.withColumn(column, F.when(~missing, F.col(column)))
        pays, receipts = (rows.where(F.col("event_type").isin(kind, CLOSING)) for kind in ("purchase", "click"))
        met = streaming.stream_reconcile(pays, receipts, ["tx_id"], "ts", "event_id", "5 hours", "3 hours")
        finish(streaming.changelog_sink(met, f"{folder}/met", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/met").drop("_batch").where("coalesce(tx_id, '') <> '-1'"))


def stream_interval_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a payment and a receipt near in time, and those of either kind that meet none."""
    folder = scratch(spark)
    with stream_settings(spark):
        rows = ordered_events(spark, sf_dir, folder).select("event_id", "ts", "event_type", F.col("user_id").cast("string").alias("tx_id"))
        pays, receipts = (rows.where(F.col("event_type").isin(kind, CLOSING)).drop("event_type") for kind in ("purchase", "click"))
        met = streaming.stream_interval_join(pays, receipts, ["tx_id"], "ts", "ts", "3 hours", "5 hours", "fullOuter")
        outcome = F.when(F.col("r_event_id").isNull(), "single_pay").when(F.col("l_event_id").isNull(), "single_receipt")
        met = met.select(
            F.coalesce("l_tx_id", "r_tx_id").alias("tx_id"), "l_event_id", "l_ts", "r_event_id", "r_ts", outcome.otherwise("matched").alias("outcome")
        )
        finish(streaming.changelog_sink(met, f"{folder}/met", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/met").drop("_batch").where("tx_id <> '-1'"))


def _clicks_by_arrival(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Clicks in eight stretches of arrivals; every tenth happened three days before its neighbours."""
    rows = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").where("event_type = 'click'")
    early = F.pmod("event_id", F.lit(10)) == 0
    rows = rows.withColumn("ts", F.when(early, F.col("ts") - F.expr("interval 3 days")).otherwise(F.col("ts")))
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    stretch = F.floor((F.col("event_id") - (low or 0)) * 8 / ((high or 0) - (low or 0) + 1))
    return in_stretches(rows, stretch, folder, 8)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests too late for every window as their stretch of arrivals is read, routed to a folder of their own."""
    folder = scratch(spark)
    with stream_settings(spark):

        def counted(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/on_time/{batch_id}")

        writer = streaming.route_late(
            _clicks_by_arrival(spark, sf_dir, folder), "ts", "3 seconds", "1 minute", "10 minutes", "5 seconds",
            counted, f"{folder}/late", f"{folder}/progress",
        )
        finish(writer, folder)
    return _zoneless(spark.read.parquet(f"{folder}/late").select("event_id", "user_id", "ts"))


def stream_windows_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per day and sliding half day: the last answer of each window, how many it gave, and its clicks too late."""
    folder = scratch(spark)
    with stream_settings(spark):
        clicks = _clicks_by_arrival(spark, sf_dir, folder)
        kinds = clicks.withColumn("part", F.pmod("user_id", F.lit(5)))
        answers = streaming.stream_counts_corrected(kinds, "ts", "1 day", "12 hours", ["part"], "3 seconds", "2 days")
        finish(streaming.changelog_sink(answers, f"{folder}/answers", mode="append"), folder)
    late = F.col("answer") == "late"
    rows = spark.read.parquet(f"{folder}/answers").where("window_start < timestamp'2099-01-01'").groupBy("part", "window_end")
    return _zoneless(
        rows.agg(
            F.max(F.when(~late, F.col("cnt"))).alias("cnt"),
            F.count(F.when(~late, 1)).alias("answers"),
            F.coalesce(F.sum(F.when(late, F.col("cnt"))), F.lit(0)).alias("late"),
        )
    )


def stream_fail_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three failures in direct succession within a day."""
    folder = scratch(spark)
    with stream_settings(spark):
        failed = F.col("event_type") == "error"
        pattern = Pattern.begin("fail", failed).times(3, consecutive=True).within("1 day")
        found = streaming.stream_match(ordered_events(spark, sf_dir, folder), ["user_id"], "ts", "event_id", pattern)
        finish(streaming.changelog_sink(found.where("outcome = 'matched'"), f"{folder}/found", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/found").drop("_batch", "outcome", "at"))


def stream_pattern_next_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view, a click right after it, and some later purchase."""
    folder = scratch(spark)
    with stream_settings(spark):
        kind = F.col("event_type")
        pattern = Pattern.begin("view", kind == "view").next("click", kind == "click").followed_by("purchase", kind == "purchase")
        found = streaming.stream_match(ordered_events(spark, sf_dir, folder), ["user_id"], "ts", "event_id", pattern.within("2 days"))
        finish(streaming.changelog_sink(found, f"{folder}/found", mode="append"), folder)
    return _zoneless(spark.read.parquet(f"{folder}/found").drop("_batch"))


def stream_click_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every click with its rank of the day and outcome, routed to a folder per outcome and read back."""
    folder = scratch(spark)
    outcomes = ("pass", "warn", "drop")
    with stream_settings(spark):
        ad = F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(3))
        clicks = ordered_events(spark, sf_dir, folder).withColumn("ad_id", F.coalesce(ad, F.lit(-1)))
        capped = streaming.stream_cap_outcomes(clicks, ["user_id", "ad_id"], "ts", "event_id", 2)
        finish(streaming.routed_sink(capped, "outcome", {o: f"{folder}/{o}" for o in outcomes}), folder)
    parts = [spark.read.parquet(f"{folder}/{o}") for o in outcomes]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _zoneless(rows.drop("_batch").where("user_id <> -1"))


def noon(ms: int) -> int:
    """A clock that stands at noon of one day, so that a run over midnight gives the same ranks."""
    return 4 * 3_600_000


def stream_click_cap_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of a user and ad that passed, warned and were dropped, had all arrived on one day; ranks by arrival."""
    folder = scratch(spark)
    with stream_settings(spark, empty_batches=False):
        ad = F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(3))
        clicks = ordered_events(spark, sf_dir, folder).withColumn("ad_id", ad)
        capped = streaming.stream_cap_by_clock(clicks, ["user_id", "ad_id"], "event_id", 2, clock=noon)
        finish(streaming.changelog_sink(capped, f"{folder}/capped", mode="append"), folder)
    rows = spark.read.parquet(f"{folder}/capped").where("user_id <> -1")
    return rows.groupBy("user_id", "ad_id", "outcome").agg(F.count("*").alias("cnt"), F.max("day_rank").alias("last_rank"))


STREAM_QUERIES = {
    f.__name__: f
    for f in (
        stream_hot_items,
        stream_hot_items_corrected,
        stream_hot_items_retract,
        stream_hot_items_state,
        stream_uv_running,
        stream_page_views,
        stream_visitors,
        stream_order_pay,
        stream_order_outcomes,
        stream_fail_bursts,
        stream_reconcile,
        stream_reconcile_nulls,
        stream_interval_outer,
        stream_late_rows,
        stream_windows_corrected,
        stream_fail_triples,
        stream_pattern_next_chain,
        stream_click_cap,
        stream_click_cap_clock,
    )
}
