"""Streams replayed from files give the results of the batch operators."""

import os

import pytest
from pyspark.sql import functions as F

from tests.support import START, at, frame, random_events, rows_of
from tidemark import operators as ops
from tidemark import schemas, streaming
from tidemark.sources import lines_source, publish, replay_events

COLUMNS = "seq bigint, key bigint, kind string, ts timestamp_ntz"
FAR = START + 40 * 86400


class Replay:
    """Event files in time order, ended by a far later row that moves the watermark past everything."""

    def __init__(self, spark, folder, events, files=3):
        self.spark, self.folder, self.events = spark, folder, sorted(events, key=lambda e: (e[3], e[0]))
        size = -(-len(self.events) // files)
        chunks = [self.events[i : i + size] for i in range(0, len(self.events), size)]
        chunks.append([(1 << 40, -1, "flush", FAR)])
        for number, chunk in enumerate(chunks):
            target = folder / "events" / f"part-{number}.parquet"
            target.parent.mkdir(exist_ok=True)
            frame(spark, chunk, COLUMNS).toPandas().to_parquet(target, coerce_timestamps="us", index=False)
            os.utime(target, (1_000_000 + number, 1_000_000 + number))

    def stream(self):
        reader = self.spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", "1")
        return reader.parquet(str(self.folder / "events"))

    def batch(self):
        return frame(self.spark, self.events, COLUMNS)

    def run(self, writer, name="q"):
        query = writer.option("checkpointLocation", str(self.folder / f"checkpoint-{name}")).trigger(availableNow=True).start()
        query.awaitTermination()

    def collect(self, stream, name):
        query = streaming.memory_sink(stream, name).option(
            "checkpointLocation", str(self.folder / f"checkpoint-{name}")
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        return self.spark.table(name).where("key <> -1") if "key" in stream.columns else self.spark.table(name)


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    events = random_events(11, 15, 25, ["a", "a", "b"], gap=9, hot=60)
    return Replay(spark, tmp_path_factory.mktemp("replay"), events)


def same(stream_result, batch_result):
    columns = batch_result.columns
    zoneless = [
        F.col(c).cast("timestamp_ntz").alias(c) if t.startswith("timestamp") else F.col(c)
        for c, t in stream_result.dtypes
    ]
    assert rows_of(stream_result.select(*zoneless).select(*columns)) == rows_of(batch_result)


def test_sliding_counts_and_ranking(replay):
    counts = streaming.stream_counts(replay.stream(), "ts", "20 seconds", "5 seconds", ["key"])
    path = str(replay.folder / "top")
    replay.run(streaming.ranked_sink(counts, 2, ["key"], path), "top")
    got = replay.spark.read.parquet(path).where("key <> -1").drop("_batch")
    batch = ops.sliding_counts(replay.batch(), "ts", "20 seconds", "5 seconds", ["key"])
    same(got, ops.top_n(batch, 2, ["key"]))


def test_tumbling_visitors(replay):
    got = replay.collect(streaming.stream_visitors(replay.stream(), "ts", "30 seconds", "key"), "visitors")
    same(got.where(F.col("window_end") < F.lit(at(FAR))), ops.exact_visitors(replay.batch(), "ts", "30 seconds", "key"))


def test_updates_are_kept_as_a_changelog(replay):
    timed = streaming.event_time(replay.stream().where("key <> -1"), "ts", "63 seconds")
    counts = timed.groupBy("key", F.window("ts", "1 minute")).agg(F.count("*").alias("cnt"))
    counts = counts.select("key", F.col("window.end").alias("window_end"), "cnt")
    path = str(replay.folder / "changes")
    replay.run(streaming.changelog_sink(counts, path), "changes")
    got = streaming.latest(replay.spark, path, ["key", "window_end"])
    same(got, ops.tumbling(replay.batch(), "ts", "1 minute", ["key"]).select("key", "window_end", "cnt"))
    assert replay.spark.read.parquet(path).count() > got.count()


def test_ranks_come_early_and_are_corrected(spark, tmp_path):
    """A late row moves an item up in a window that has been ranked before."""
    rows = [(0, 1, "a", START), (1, 1, "a", START + 1), (2, 2, "a", START + 2)]
    replay = Replay(spark, tmp_path, rows, files=1)
    path, seen = str(tmp_path / "ranked"), []

    def counts():
        timed = streaming.event_time(replay.stream().where("key <> -1"), "ts", "1 hour")
        by_key = timed.groupBy("key", F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("cnt"))
        return by_key.select("key", F.col("w.end").alias("window_end"), "cnt")

    for late in (None, [(10 + i, 2, "a", START + 3 + i) for i in range(3)]):
        if late:
            target = tmp_path / "events" / "part-9.parquet"
            frame(spark, late, COLUMNS).toPandas().to_parquet(target, coerce_timestamps="us", index=False)
        replay.run(streaming.corrected_ranked_sink(counts(), 1, ["key"], path), "ranked")
        seen.append([(r.key, r.cnt) for r in streaming.upserted(spark, f"{path}/top").collect()])
    assert seen == [[(1, 2)], [(2, 4)]]
    assert streaming.upserted(spark, f"{path}/counts").count() == 2


def test_a_new_stream_must_not_continue_an_old_log(replay):
    path = str(replay.folder / "twice")
    for name in ("first", "second"):
        changes = replay.stream().select("key", "seq")
        if name == "first":
            replay.run(streaming.changelog_sink(changes, path, mode="append"), name)
        else:
            with pytest.raises(Exception, match="earlier stream"):
                replay.run(streaming.changelog_sink(changes, path, mode="append"), name)


def test_a_row_that_closes_and_opens_does_both(spark, tmp_path):
    rows = [(0, 1, "a", START), (1, 1, "ab", START + 2), (2, 1, "b", START + 4)]
    replay = Replay(spark, tmp_path, rows, files=1)
    opens, closes = F.col("kind").contains("a"), F.col("kind").contains("b")
    stream = streaming.stream_followed_by(replay.stream(), ["key"], "ts", "seq", opens, closes, "6 seconds")
    pattern = ops.Pattern.begin("open", opens).followed_by("close", closes).within("6 seconds")
    same(replay.collect(stream, "both"), ops.match(replay.batch(), ["key"], "ts", "seq", pattern))


def test_interval_join_with_unmatched_rows(replay):
    a, b = replay.stream().where("kind <> 'b'"), replay.stream().where("kind <> 'a'")
    got = replay.collect(
        streaming.stream_interval_join(a, b, ["key"], "ts", "ts", "3 seconds", "5 seconds", "fullOuter"), "joined"
    ).where("coalesce(l_kind, '') <> 'flush' and coalesce(r_kind, '') <> 'flush'")
    batch = ops.interval_outer_join(
        replay.batch().where("kind = 'a'"), replay.batch().where("kind = 'b'"), ["key"], "ts", "ts", "seq", "seq",
        "3 seconds", "5 seconds",
    )
    same(got.select("l_seq", "r_seq"), batch.select("l_seq", "r_seq"))


A, B = "kind = 'a'", "kind = 'b'"


def test_followed_by(replay):
    stream = streaming.stream_followed_by(replay.stream(), ["key"], "ts", "seq", F.expr(A), F.expr(B), "6 seconds")
    pattern = ops.Pattern.begin("open", F.expr(A)).followed_by("close", F.expr(B)).within("6 seconds")
    same(replay.collect(stream, "followed"), ops.match(replay.batch(), ["key"], "ts", "seq", pattern))


def test_open_close_outcomes(replay):
    stream = streaming.stream_open_close_outcomes(
        replay.stream(), ["key"], "ts", "seq", F.expr(A), F.expr(B), "6 seconds", patience="30 days"
    )
    batch = ops.open_close_outcomes(replay.batch(), ["key"], "ts", "seq", F.expr(A), F.expr(B), "6 seconds")
    same(replay.collect(stream, "outcomes"), batch)


def test_failure_bursts(replay):
    stream = streaming.stream_failure_bursts(replay.stream(), ["key"], "ts", "seq", F.expr(A), "5 seconds", 3)
    batch = ops.failure_bursts(replay.batch(), ["key"], "ts", "seq", F.expr(A), "5 seconds", 3)
    same(replay.collect(stream, "bursts"), batch)


def test_cap_outcomes(replay):
    stream = streaming.stream_cap_outcomes(replay.stream(), ["key"], "ts", "seq", 5)
    batch = ops.cap_outcomes(replay.batch(), ["key"], "ts", "seq", 5)
    same(replay.collect(stream, "capped"), batch.select("key", "ts", "seq", "day_rank", "outcome"))


def test_reconcile(replay):
    # The closing row belongs to both sides, so that it moves both watermarks.
    a, b = replay.stream().where("kind <> 'b'"), replay.stream().where("kind <> 'a'")
    stream = streaming.stream_reconcile(a, b, ["key"], "ts", "seq", "5 seconds", "3 seconds")
    batch = ops.reconcile(
        replay.batch().where(A), replay.batch().where(B), ["key"], "ts", "ts", "seq", "seq", "5 seconds", "3 seconds"
    )
    same(replay.collect(stream, "reconciled"), batch)


def test_routing_by_outcome(replay):
    capped = streaming.stream_cap_outcomes(replay.stream(), ["key"], "ts", "seq", 5)
    targets = {o: str(replay.folder / f"routed-{o}") for o in ("pass", "warn", "drop")}
    replay.run(streaming.routed_sink(capped, "outcome", targets), "routed")
    batch = ops.cap_outcomes(replay.batch(), ["key"], "ts", "seq", 5)
    for outcome, path in targets.items():
        got = replay.spark.read.parquet(path).where("key <> -1")
        same(got.select("seq"), batch.where(F.col("outcome") == outcome).select("seq"))


def test_late_rows_are_routed_once(spark, tmp_path):
    early = [(i, 1, "a", START + 100 + i) for i in range(20)]
    late = [(100, 1, "late", START), (101, 1, "a", START + 110)]
    replay = Replay(spark, tmp_path, early, files=1)
    target = tmp_path / "events" / "part-9.parquet"
    frame(spark, late, COLUMNS).toPandas().to_parquet(target, coerce_timestamps="us", index=False)
    os.utime(target, (1_000_000.5, 1_000_000.5))
    kept = []
    writer = streaming.route_late(
        replay.stream(), "ts", "3 seconds", "10 seconds", "60 seconds", "5 seconds",
        lambda batch, batch_id: kept.extend(r.seq for r in batch.collect()),
        str(tmp_path / "late"), str(tmp_path / "progress"),
    )
    replay.run(writer, "late")
    assert [r.seq for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [100]
    assert sorted(kept) == [*range(20), 101, 1 << 40]


def test_file_replay_and_topic_round_trip(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.csv").write_text("1,create,,10\n1,pay,tx,12\n")
    events = replay_events(spark, str(tmp_path / "files"), schemas.ORDER)
    writer = publish(events.withColumn("ts", F.unix_seconds("ts")), "parquet", key="order_id", path=str(tmp_path / "topic"))
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    lines = lines_source(spark, "parquet", path=str(tmp_path / "topic"))
    assert lines.isStreaming and lines.columns == ["value"]
    assert rows_of(spark.read.parquet(str(tmp_path / "topic")).select("key", "value")) == [
        ("1", '1,create,"",10'), ("1", "1,pay,tx,12"),
    ]


def test_patterns_of_several_stages(replay):
    kind = F.col("kind")
    pattern = ops.Pattern.begin("x", kind == "a").next("y", kind == "a").followed_by("z", kind == "b").within("8 seconds")
    for slice in (None, "8 seconds", "3 seconds"):
        stream = streaming.stream_match(replay.stream(), ["key"], "ts", "seq", pattern, slice=slice)
        same(replay.collect(stream, f"chain_{(slice or 'x')[0]}"), ops.match(replay.batch(), ["key"], "ts", "seq", pattern))
    thrice = ops.Pattern.begin("x", kind == "a").times(3, consecutive=True).within("5 seconds")
    stream = streaming.stream_match(replay.stream(), ["key"], "ts", "seq", thrice)
    same(replay.collect(stream, "thrice"), ops.match(replay.batch(), ["key"], "ts", "seq", thrice))


def test_a_hot_key_has_several_state_partitions(replay):
    """Key 0 holds a third of all rows."""
    pattern = ops.Pattern.begin("open", F.expr(A)).followed_by("close", F.expr(B)).within("6 seconds")
    stream = streaming.stream_match(replay.stream(), ["key"], "ts", "seq", pattern, slice="6 seconds")
    partitions = set()

    def write(batch, batch_id):
        partitions.update(r[0] for r in batch.where("key = 0").select(F.spark_partition_id()).distinct().collect())

    replay.run(stream.writeStream.foreachBatch(write), "hot")
    assert len(partitions) > 1


def test_many_waiting_rows_lie_in_pieces(spark, tmp_path, monkeypatch):
    """Bounds so small that rows are cut into pieces and queues into chunks."""
    from tidemark.streaming import stateful

    for name in ("FEW_ROWS", "PIECE_ROWS", "CHUNK_ROWS", "ARRIVING_ROWS"):
        monkeypatch.setattr(stateful, name, 3)
    replay = Replay(spark, tmp_path, random_events(5, 3, 20, ["a", "a", "b"], gap=2, hot=80))
    a, b = replay.stream().where("kind <> 'b'"), replay.stream().where("kind <> 'a'")
    stream = streaming.stream_reconcile(a, b, ["key"], "ts", "seq", "40 seconds", "30 seconds", delay="20 seconds")
    batch = ops.reconcile(replay.batch().where(A), replay.batch().where(B), ["key"], "ts", "ts", "seq", "seq", "40 seconds", "30 seconds")
    same(replay.collect(stream, "pieces"), batch)
    stream = streaming.stream_followed_by(replay.stream(), ["key"], "ts", "seq", F.expr(A), F.expr(B), "9 seconds", delay="20 seconds")
    pattern = ops.Pattern.begin("open", F.expr(A)).followed_by("close", F.expr(B)).within("9 seconds")
    same(replay.collect(stream, "chunks"), ops.match(replay.batch(), ["key"], "ts", "seq", pattern))


def test_many_keys_share_state_and_calls(spark, tmp_path, monkeypatch):
    """State does not grow by a value and a timer for each key; keys of any type come back as they were."""
    from tidemark.streaming import stateful

    for name, value in (("BUCKETS", 4), ("FEW_KEYS", 3), ("KEY_BLOCKS", 5), ("PACKED_ROWS", 7)):
        monkeypatch.setattr(stateful, name, value, raising=False)
    replay = Replay(spark, tmp_path, random_events(13, 400, 6, ["a", "b"], gap=4))
    keys = {
        "name": F.when(F.col("key") % 50 != 0, F.concat(F.lit('k "\\ \n'), F.col("key") % 90)),
        "since": F.timestamp_micros(F.col("key") + F.lit(10**15)).cast("timestamp_ntz"),
    }
    stream, batch = replay.stream().withColumns(keys), replay.batch().withColumns(keys)
    pattern = ops.Pattern.begin("open", F.expr(A)).followed_by("close", F.expr(B)).within("6 seconds")
    runs = {
        "shared_match": (
            streaming.stream_followed_by(stream, list(keys), "ts", "seq", F.expr(A), F.expr(B), "6 seconds", delay="20 seconds"),
            ops.match(batch, list(keys), "ts", "seq", pattern),
        ),
        "shared_cap": (
            streaming.stream_cap_outcomes(stream, list(keys), "ts", "seq", 2),
            ops.cap_outcomes(batch, list(keys), "ts", "seq", 2).select(*keys, "ts", "seq", "day_rank", "outcome"),
        ),
    }
    for name, (got, want) in runs.items():
        query = streaming.memory_sink(got, name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
        found = spark.table(name)
        same(found.where("seq < 1000000") if "seq" in found.columns else found, want)
        assert 0 < max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) < 150, name


def test_incomplete_rows_fare_as_in_batch(spark, tmp_path):
    events = random_events(7, 6, 20, ["a", "b"], gap=4)
    replay = Replay(spark, tmp_path, events)
    holes = {"key": F.when((F.col("seq") % 5 != 0) | (F.col("kind") == "flush"), F.col("key")), "ts": F.when((F.col("seq") % 7 != 0) | (F.col("kind") == "flush"), F.col("ts"))}
    stream, batch = replay.stream().withColumns(holes), replay.batch().withColumns(holes)
    met = streaming.stream_reconcile(stream.where("kind <> 'b'"), stream.where("kind <> 'a'"), ["key"], "ts", "seq", "5 seconds", "3 seconds")
    want = ops.reconcile(batch.where(A), batch.where(B), ["key"], "ts", "ts", "seq", "seq", "5 seconds", "3 seconds")
    replay.run(streaming.memory_sink(met, "holes"), "holes")
    same(spark.table("holes").where("coalesce(key, 0) <> -1"), want)
    capped = streaming.stream_cap_outcomes(stream, ["key"], "ts", "seq", 3, days=1)
    replay.run(streaming.memory_sink(capped, "capped_holes"), "capped_holes")
    got = spark.table("capped_holes").where("coalesce(key, 0) <> -1")
    want = ops.cap_outcomes(batch, ["key"], "ts", "seq", 3)
    same(got.where("ts is not null"), want.where("ts is not null").select("key", "ts", "seq", "day_rank", "outcome"))
    # Without a time rows rank as they arrive; which of a batch's files comes first does not change the ranks given.
    same(got.where("ts is null").select("key", "day_rank", "outcome"), want.where("ts is null").select("key", "day_rank", "outcome"))


# Tables of batches


def versions(spark, path, batches, fail_at=None):
    """Upsert batches of (key, value); the expected table after each."""
    from tidemark.streaming import store

    table = {}
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "key bigint, value string")
        store.upsert(df, path, ["key"], F.col("key") % 3, number)
        table.update(dict(rows))
        yield number, dict(table)


BATCHES = [[(i, f"v{i}") for i in range(30)], [(1, "a"), (40, "b")], [], [(i, "c") for i in range(0, 30, 2)], [(None, "n")], [(41, "d"), (None, "m")], [(1, "e")]]


def test_store_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    for number, want in versions(spark, path, BATCHES):
        got = streaming.upserted(spark, path)
        assert dict(got.collect()) == want
        if number:
            assert dict(streaming.upserted(spark, path, number - 1).collect()) == before
        before = want


def test_a_batch_that_died_is_repeated(spark, tmp_path, monkeypatch):
    """The version before stays whole whatever part of the batch was done, and the repeated batch gives the same table."""
    from tidemark.streaming import store

    path = str(tmp_path / "table")
    for number, want in versions(spark, path, BATCHES[:4]):
        pass
    fresh = spark.createDataFrame([(1, "z"), (99, "new")], "key bigint, value string")
    for step in ("_write", "_merged", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(store, step, lambda *args: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                store.MOST_DELTAS, kept = -1, store.MOST_DELTAS
                try:
                    store.upsert(fresh, path, ["key"], F.col("key") % 3, 4)
                finally:
                    store.MOST_DELTAS = kept
        assert dict(streaming.upserted(spark, path).collect()) == want
    for _ in range(2):
        store.upsert(fresh, path, ["key"], F.col("key") % 3, 4)
        assert dict(streaming.upserted(spark, path).collect()) == {**want, 1: "z", 99: "new"}


def test_every_prefix_of_the_log_is_the_table(replay):
    timed = streaming.event_time(replay.stream().where("key <> -1"), "ts", "63 seconds")
    counts = timed.groupBy("key", F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("cnt"))
    counts = counts.select("key", F.col("w.end").alias("window_end"), "cnt")
    path, seen = str(replay.folder / "retract"), []
    replay.run(streaming.retract_sink(counts, path, ["key", "window_end"], F.lit("all")), "retract")
    log = streaming.retractions(replay.spark, path)
    batches = sorted(r[0] for r in log.select("_batch").distinct().collect())
    rows = replay.events
    size = -(-len(rows) // 3)
    for number in batches:
        seen = rows[: size * (number + 1)]
        want = ops.tumbling(frame(replay.spark, seen, COLUMNS), "ts", "1 minute", ["key"]).select("key", "window_end", "cnt")
        same(streaming.net(log.where(F.col("_batch") <= number)), want)
    kinds = {r[0] for r in log.select("change").distinct().collect()}
    assert kinds == {"insert", "update_before", "update_after"}


def test_changes_of_two_tables(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, None)], "k bigint, v string")
    after = spark.createDataFrame([(1, "a"), (2, "x"), (None, "d"), (5, None)], "k bigint, v string")
    assert rows_of(streaming.changes(before, after, ["k"])) == sorted(
        [("update_before", 2, "b"), ("update_after", 2, "x"), ("update_before", None, "c"), ("update_after", None, "d"), ("delete", 4, None), ("insert", 5, None)],
        key=repr,
    )


def test_windows_answer_early_and_are_corrected(spark, tmp_path):
    rows = [(0, 1, "a", START), (1, 1, "a", START + 1), (2, 1, "a", START + 30)]
    late = [[(3, 1, "a", START + 2), (4, 1, "a", START + 40)], [(5, 1, "a", START + 3), (6, 1, "a", START + 90)], [(7, 1, "a", START + 4)]]
    replay = Replay(spark, tmp_path, rows, files=1)
    os.remove(tmp_path / "events" / "part-1.parquet")
    for number, chunk in enumerate([*late, [(1 << 40, -1, "flush", FAR)]]):
        target = tmp_path / "events" / f"part-9{number}.parquet"
        frame(spark, chunk, COLUMNS).toPandas().to_parquet(target, coerce_timestamps="us", index=False)
        os.utime(target, (1_000_010 + number, 1_000_010 + number))
    answers = streaming.stream_counts_corrected(replay.stream(), "ts", "10 seconds", None, ["key"], "2 seconds", "40 seconds")
    path = str(tmp_path / "answers")
    replay.run(streaming.changelog_sink(answers, path, mode="append"), "answers")
    found = spark.read.parquet(path).where("key = 1 and window_start = timestamp_seconds(%d)" % START).orderBy("_batch", "cnt")
    assert [(r.answer, r.cnt) for r in found.collect()] == [("first", 2), ("corrected", 3), ("corrected", 4), ("late", 1)]


def test_running_visitors_of_any_id(spark, tmp_path):
    """Ids far apart, negative and missing; several rows at one time."""
    ids = [0, 5, 4095, 4096, -1 << 40, 1 << 61, 77, -2]
    events = [(i, ids[i * 5 % 8], "a", START + i // 3 * 5) for i in range(120)]
    replay = Replay(spark, tmp_path, events)
    named = F.when(F.col("key") != 77, F.col("key"))
    rows = replay.stream().withColumn("key", named)
    running = streaming.stream_running_visitors(rows, "ts", "seq", "30 seconds", "key", delay="20 seconds")
    got = replay.collect(running, "running").where(F.col("window_end") < F.lit(at(FAR)))
    same(got, ops.running_visitors(replay.batch().withColumn("key", named), "ts", "seq", "30 seconds", "key"))


def test_running_visitors_per_key(replay):
    rows = replay.stream().withColumn("user", F.pmod(F.col("seq") * 7, F.lit(5)))
    running = streaming.stream_running_visitors(rows, "ts", "seq", "1 minute", "user", keys=["key"])
    got = {tuple(r) for r in replay.collect(running, "per_key").select("key", F.unix_micros("ts"), "seq", "cnt").collect()}
    want, seen = set(), {}
    for seq, key, _, ts in replay.events:
        members = seen.setdefault((key, int(ts // 60)), set())
        if seq * 7 % 5 not in members:
            members.add(seq * 7 % 5)
            want.add((key, round(ts * 1_000_000), seq, len(members)))
    assert got == want


def test_best_rows_of_windows_in_list_state(replay):
    counts = streaming.stream_counts(replay.stream(), "ts", "20 seconds", "5 seconds", ["key", "kind"])
    for salts in (1, 4):
        path = str(replay.folder / f"best-{salts}")
        best = streaming.stream_best_rows(counts, 2, ["key", "kind"], salts)
        replay.run(streaming.ranked_sink(best, 2, ["key", "kind"], path), f"best-{salts}")
        got = replay.spark.read.parquet(path).where("key <> -1").drop("_batch")
        batch = ops.sliding_counts(replay.batch(), "ts", "20 seconds", "5 seconds", ["key", "kind"])
        same(got, ops.top_n(batch, 2, ["key", "kind"]).select(*[c for c in got.columns]))
