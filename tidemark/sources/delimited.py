"""Comma-delimited events without a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import epoch_millis, epoch_seconds

CORRUPT = "_corrupt_record"


def _typed(df: DataFrame, unit: str) -> DataFrame:
    """Epoch numbers become timestamps; a missing text field is the empty string, as in the file."""
    to_ts = {"s": epoch_seconds, "ms": epoch_millis}[unit]

    def column(field: T.StructField) -> Column:
        if field.name == "ts":
            return to_ts("ts").alias("ts")
        if isinstance(field.dataType, T.StringType) and field.name != CORRUPT:
            return F.coalesce(F.col(field.name), F.lit("")).alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def read_events(
    spark: SparkSession, path: str | list[str], schema: str, unit: str = "s", quarantine: bool = False
) -> DataFrame:
    """Read a bounded file or folder of events.

    A malformed row ends the job; with ``quarantine`` it is kept in
    ``_corrupt_record`` instead.
    """
    reader = spark.read.options(emptyValue="", mode="PERMISSIVE" if quarantine else "FAILFAST")
    if quarantine:
        schema = f"{schema}, {CORRUPT} STRING"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return _typed(reader.schema(schema).csv(path), unit)


def parse_lines(lines: DataFrame, schema: str, unit: str = "s", quarantine: bool = False) -> DataFrame:
    """Parse a ``value`` column of event lines, batch or streaming, from a file, topic or socket."""
    options = {"emptyValue": "", "mode": "PERMISSIVE" if quarantine else "FAILFAST"}
    if quarantine:
        schema = f"{schema}, {CORRUPT} STRING"
        options["columnNameOfCorruptRecord"] = CORRUPT
    rest = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*rest, F.from_csv("value", schema, options).alias("_e")).select(*rest, "_e.*")
    return _typed(parsed, unit)
