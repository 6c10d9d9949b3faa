"""The test tables seen as the event kinds the library works on.

A view keeps all rows that are events of its kind; names and labels change. Events of
one user are hours apart here, so the queries scale the usual seconds and
minutes up accordingly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROVINCES = [f"region {i}" for i in range(7)]
CHANNELS = ["search", "mail", "partner", "direct"]


def label(key: str, names: list[str]) -> Column:
    at = (F.pmod(F.col(key), F.lit(len(names))) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type"))
    return events(spark, sf_dir).select("event_id", "user_id", _k().alias("item_id"), kind.alias("behavior"), "ts")


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = F.when(F.col("event_type") == "click", "GET").otherwise("POST")
    url = F.concat(F.lit("/page/"), _k().cast("string"))
    return events(spark, sf_dir).select("event_id", "user_id", method.alias("method"), url.alias("url"), "ts")


def delayed_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``access`` in which every tenth request happened two hours before its neighbours in arrival order."""
    rows = access(spark, sf_dir)
    early = F.col("ts") - F.expr("interval 2 hours")
    return rows.withColumn("ts", F.when(F.pmod("event_id", F.lit(10)) == 0, early).otherwise(F.col("ts")))


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", "user_id", F.col("event_type").alias("behavior"), label("user_id", CHANNELS).alias("channel"), "ts"
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", "user_id", F.pmod(_k(), F.lit(3)).alias("ad_id"), label("user_id", PROVINCES).alias("province"), "ts"
    )


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    return events(spark, sf_dir).select("event_id", "user_id", kind.alias("event_type"), "ts")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signup creates the user's order, a purchase pays it; other events are no order events."""
    rows = events(spark, sf_dir).where(F.col("event_type").isin("signup", "purchase"))
    kind = F.when(F.col("event_type") == "signup", "create").otherwise("pay")
    return rows.select("event_id", F.col("user_id").alias("order_id"), kind.alias("event_type"), "ts")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases carry the user's transaction id; all other events have none."""
    tx = F.when(F.col("event_type") == "purchase", F.col("user_id").cast("string")).otherwise("")
    return events(spark, sf_dir).select("event_id", tx.alias("tx_id"), "ts")


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where(F.col("event_type") == "click")
    return rows.select("event_id", F.col("user_id").cast("string").alias("tx_id"), "ts")


def patchy(rows: DataFrame, column: str, every: int, by: str = "event_id") -> DataFrame:
    """``rows`` with ``column`` null in one of ``every`` rows."""
    return rows.withColumn(column, F.when(F.pmod(by, F.lit(every)) != 0, F.col(column)))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access log text written from the events."""
    rows = access(spark, sf_dir)
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256)).cast("string")),
        F.col("user_id").cast("string"),
        F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
        F.lit("+0000"),
        "method",
        "url",
    )
    return rows.select(line.alias("value"))
