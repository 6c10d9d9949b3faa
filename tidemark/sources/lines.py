"""Line streams (topic, socket, files) and publishing rows as lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.clock import floor_div, micros
from tidemark.sources.delimited import parse_lines


def lines_source(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """An unbounded ``value`` column of text lines, e.g.

    ``lines_source(spark, "kafka", subscribe="clicks", **{"kafka.bootstrap.servers": "…"})``
    or ``lines_source(spark, "socket", host="…", port="…")`` or
    ``lines_source(spark, "text", path="…", maxFilesPerTrigger="1")``.

    A topic starts at its latest offset unless ``startingOffsets`` says otherwise.
    """
    if format == "kafka":
        options = {"startingOffsets": "latest", **options}
    reader = spark.readStream.format(format).options(**options)
    if format == "parquet":
        reader = reader.schema("key STRING, value STRING")
    return reader.load().select(F.col("value").cast("string").alias("value"))


def replay_events(
    spark: SparkSession, path: str, schema: str, unit: str = "s", files_per_trigger: int = 1
) -> DataFrame:
    """A bounded folder of event files replayed as a stream, oldest file first.

    Start the query with ``trigger(availableNow=True)``. Spark orders files by
    modification time, so that order must be the order of events.
    """
    lines = lines_source(spark, "text", path=path, maxFilesPerTrigger=str(files_per_trigger))
    return parse_lines(lines, schema, unit)


def as_messages(df: DataFrame, key: Column | str | None = None, unit: str = "s") -> DataFrame:
    """Rows as ``key, value`` text messages that ``parse_lines`` reads back, the value being a comma-delimited line.

    Times are written as whole epoch ``unit`` (s or ms, rounded down); text keeps its blanks.
    """
    key_column = F.lit(None) if key is None else (F.col(key) if isinstance(key, str) else key)
    width = {"s": 1_000_000, "ms": 1_000}[unit]

    def written(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return floor_div(micros(df, field.name), width).alias(field.name)
        return F.col(field.name)

    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*[written(f) for f in df.schema.fields]), options)
    return df.select(key_column.cast("string").alias("key"), line.alias("value"))


def publish(
    df: DataFrame, format: str, key: Column | str | None = None, unit: str = "s", **options: str
) -> DataStreamWriter | None:
    """Write rows as text messages to a topic or any other sink.

    A batch frame is written at once; for a stream the prepared writer is
    returned, to be given a trigger and started.
    """
    messages = as_messages(df, key, unit)
    if df.isStreaming:
        return messages.writeStream.format(format).options(**options)
    messages.write.format(format).mode("append").options(**options).save()
    return None
