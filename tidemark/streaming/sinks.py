"""Where streams end: labelled prints, ranked windows, upserted results and routed outcomes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.clock import Span, floor_div, micros, span_us
from tidemark.operators.lateness import LAST_INSTANT_US
from tidemark.operators.ranking import top_n
from tidemark.streaming import store

BATCH = "_batch"


def console_sink(stream: DataFrame, label: str, mode: str = "append") -> DataStreamWriter:
    """Print rows under a query name."""
    return stream.writeStream.format("console").queryName(label).outputMode(mode).option("truncate", "false")


def memory_sink(stream: DataFrame, label: str, mode: str = "append") -> DataStreamWriter:
    """Keep rows in an in-memory table called ``label``, for tests and debugging."""
    return stream.writeStream.format("memory").queryName(label).outputMode(mode)


def _append_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch to its own folder; a repeated batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def ranked_sink(counts: DataFrame, n: int, keys: Sequence[str], path: str) -> DataStreamWriter:
    """Write the top ``n`` of every window. ``counts`` comes from ``stream_counts``.

    In append mode all counts of a window are emitted together, so each batch
    can rank its windows by itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _append_batch(top_n(batch, n, keys), path, batch_id)

    return counts.writeStream.outputMode("append").foreachBatch(write)


def changelog_sink(stream: DataFrame, path: str, mode: str = "update") -> DataStreamWriter:
    """Append every changed row with its batch number; ``latest`` gives the current table.

    The log grows with the stream; ``upsert_sink`` keeps current rows only. A stream begun anew (batch 0 without a
    checkpoint) must not find the log of an earlier one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 and store.exists(batch.sparkSession, f"{path}/{BATCH}=1"):
            raise ValueError(f"{path} holds the changes of an earlier stream; take a new folder for a new checkpoint")
        _append_batch(batch, path, batch_id)

    return stream.writeStream.outputMode(mode).foreachBatch(write)


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of each row of a changelog. Map tasks combine before the shuffle."""
    changes = spark.read.parquet(path)
    values = [c for c in changes.columns if c not in (*keys, BATCH)]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("_row"))
    return newest.select(*keys, "_row.*")


def upsert_sink(
    stream: DataFrame, path: str, keys: Sequence[str], bucket: Column, mode: str = "update"
) -> DataStreamWriter:
    """Keep one row per key in a ``store`` table; ``bucket`` cuts it into folders, e.g. by days of the window.

    Read it with ``upserted``, now or as it was after an earlier batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, path, keys, bucket, batch_id)

    return stream.writeStream.outputMode(mode).foreachBatch(write)


def upserted(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current rows of an ``upsert_sink``, or those after batch ``version`` if that is one of the last two."""
    return store.rows(spark, path, version).drop(store.BUCKET)


def retract_sink(
    stream: DataFrame, path: str, keys: Sequence[str], bucket: Column, mode: str = "update"
) -> DataStreamWriter:
    """An ``upsert_sink`` to ``path/table`` that also logs what each batch changed in ``path/log``.

    The log holds ``changes`` of each batch: a new row, or the old row taken back and the new one. Read it with
    ``retractions``; ``net`` of any prefix of it is the table after that batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            before = store.rows(batch.sparkSession, f"{path}/table", batch_id - 1, kept, bucket)
            here = kept.select(*keys)
            before = None if before is None else before.drop(store.BUCKET).join(here, list(keys), "left_semi")
            _append_batch(changes(before, kept, keys), f"{path}/log", batch_id)
            store.upsert(kept, f"{path}/table", keys, bucket, batch_id)
        finally:
            kept.unpersist()

    return stream.writeStream.outputMode(mode).foreachBatch(write)


INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"


def changes(before: DataFrame | None, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns the rows ``before`` into the rows ``after``, one per key in each: rows with ``change``.

    ``insert`` and ``delete`` come alone; a row with other values comes as ``update_before`` (its old values, taken back) and
    ``update_after``. Equal rows give nothing. Null keys are keys.
    """
    if before is None:
        return after.select(F.lit(INSERT).alias("change"), *after.columns)
    sides = [
        side.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.struct(*after.columns).alias(name))
        for side, name in ((before, "_old"), (after, "_new"))
    ]
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & sides[0][f"_key{i}"].eqNullSafe(sides[1][f"_key{i}"])
    both = sides[0].join(sides[1], same, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    pair = F.array(
        F.when(old, F.struct(F.when(new, BEFORE).otherwise(DELETE).alias("change"), F.col("_old").alias("row"))),
        F.when(new, F.struct(F.when(old, AFTER).otherwise(INSERT).alias("change"), F.col("_new").alias("row"))),
    )
    return both.select(F.explode(F.filter(pair, lambda x: x.isNotNull())).alias("c")).select("c.change", "c.row.*")


def retractions(spark: SparkSession, path: str) -> DataFrame:
    """The log of a ``retract_sink``, with its batches."""
    return spark.read.parquet(f"{path}/log")


def net(log: DataFrame) -> DataFrame:
    """The rows that stand after a log, or a prefix of it: those put in and not taken back."""
    columns = [c for c in log.columns if c not in ("change", BATCH)]
    sign = F.when(F.col("change").isin(INSERT, AFTER), 1).otherwise(-1)
    # Update pairs cancel in the map tasks.
    return log.groupBy(*columns).agg(F.sum(sign).alias("_standing")).where("_standing > 0").drop("_standing")


def corrected_ranked_sink(
    counts: DataFrame, n: int, keys: Sequence[str], path: str, width: Span = "1 day", log: bool = False
) -> DataStreamWriter:
    """The top ``n`` of every window, early and then corrected as late rows raise counts.

    ``counts`` has ``window_end``, ``cnt`` and the keys, and is in update mode. Counts are kept in ``path/counts``, in
    buckets of ``width`` of the window's end; each batch ranks anew the windows it changed and replaces their rows in
    ``path/top``. Read with ``upserted(spark, f"{path}/top")``; with ``log``, every change of a rank is also a row of
    ``retractions(spark, path)``.
    """
    window = ["window_end"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = floor_div(micros(batch, "window_end"), span_us(width))
        kept = batch.persist()
        try:
            store.upsert(kept, f"{path}/counts", [*window, *keys], bucket, batch_id)
            changed = kept.select(*window, bucket.cast("string").alias(store.BUCKET)).distinct()
            # The bucket is the table's folder: only touched folders are read.
            current = store.rows(spark, f"{path}/counts", batch_id)
            if current is None:
                return
            ranked = top_n(current.join(changed, [store.BUCKET, *window], "left_semi").drop(store.BUCKET), n, keys).persist()
            try:
                if log:
                    before = store.rows(spark, f"{path}/top", batch_id - 1)
                    if before is not None:
                        before = before.join(changed, [store.BUCKET, *window], "left_semi").select(*ranked.columns)
                    _append_batch(changes(before, ranked, [*window, "row_num"]), f"{path}/log", batch_id)
                store.upsert(ranked, f"{path}/top", [*window, "row_num"], bucket, batch_id)
            finally:
                ranked.unpersist()
        finally:
            kept.unpersist()

    return counts.writeStream.outputMode("update").foreachBatch(write)


def routed_sink(
    stream: DataFrame, column: str, targets: Mapping[str, str], mode: str = "append"
) -> DataStreamWriter:
    """Send each row to the folder ``targets`` names for its value in ``column``; each batch is computed once and written once per target."""
    unknown = F.raise_error(F.concat(F.lit("no target for "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = batch.withColumn(column, F.when(F.col(column).isin(*targets), F.col(column)).otherwise(unknown))
        kept = checked.persist()
        try:
            for value, path in targets.items():
                _append_batch(kept.where(F.col(column) == value), path, batch_id)
        finally:
            kept.unpersist()

    return stream.writeStream.outputMode(mode).foreachBatch(write)


def route_late(
    stream: DataFrame,
    ts: str,
    delay: Span,
    allowed: Span,
    size: Span,
    slide: Span | None,
    on_time: Callable[[DataFrame, int], None],
    late_path: str,
    progress_path: str,
) -> DataStreamWriter:
    """Hand on-time rows of each batch to ``on_time`` and write rows late for all their windows to ``late_path``.

    The watermark of a batch is the greatest event time of the batches before
    it, less ``delay``. It is kept in ``progress_path``, one value per batch, so
    a restarted or repeated batch is split as before.
    """
    slide_us = span_us(slide if slide is not None else size)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        us = micros(batch, ts)
        if batch_id == 0:
            watermark = None
        else:
            # Each batch leaves the greatest time of all so far, so only the one before is read.
            watermark = spark.read.schema("max_us bigint").parquet(f"{progress_path}/{BATCH}={batch_id - 1}").first()[0]
        kept = batch.persist()
        try:
            closed_at = floor_div(us, slide_us) * slide_us + (span_us(size) - LAST_INSTANT_US + span_us(allowed))
            is_late = F.lit(False) if watermark is None else closed_at <= F.lit(watermark - span_us(delay))
            _append_batch(kept.where(is_late), late_path, batch_id)
            on_time(kept.where(~is_late), batch_id)
            reached = F.greatest(F.max(us), F.lit(watermark).cast("bigint"))
            _append_batch(kept.agg(reached.alias("max_us")), progress_path, batch_id)
        finally:
            kept.unpersist()

    return stream.writeStream.outputMode("append").foreachBatch(write)
