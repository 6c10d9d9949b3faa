"""Space-separated web server access logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import access_log_time
from tidemark.schemas import ACCESS_LOG_FIELDS


def parse_access_log(lines: DataFrame, quarantine: bool = False) -> DataFrame:
    """``ip, user_id, ts, method, url`` from a ``value`` column of log lines, batch or streaming.

    A line that is too short or has no valid time ends the job; with
    ``quarantine`` its text is kept in ``_corrupt_record`` and the rest is null.
    """
    parts = F.split("value", " ")
    field = {name: F.get(parts, F.lit(i)) for name, i in ACCESS_LOG_FIELDS.items()}
    rest = [c for c in lines.columns if c != "value"]
    parsed = lines.select(
        *rest,
        field["ip"].alias("ip"),
        field["user_id"].alias("user_id"),
        access_log_time(field["time"], lenient=True).alias("ts"),
        field["method"].alias("method"),
        field["url"].alias("url"),
        "value",
    )
    good = F.col("ts").isNotNull() & F.col("url").isNotNull()
    names = ("ip", "user_id", "ts", "method", "url")
    if quarantine:
        return parsed.select(
            *rest,
            *[F.when(good, F.col(c)).alias(c) for c in names],
            F.when(~good, F.col("value")).alias("_corrupt_record"),
        )
    bad = F.raise_error(F.concat(F.lit("MALFORMED access log line: "), F.coalesce("value", F.lit("null"))))
    return parsed.select(*rest, *[F.when(good, F.col(c)).otherwise(bad.cast(parsed.schema[c].dataType)).alias(c) for c in names])


def read_access_log(spark: SparkSession, path: str | list[str], quarantine: bool = False) -> DataFrame:
    return parse_access_log(spark.read.text(path), quarantine)
