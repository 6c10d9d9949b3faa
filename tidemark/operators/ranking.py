"""Top-N per window and its text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def top_n(
    counts: DataFrame, n: int, keys: Sequence[str], by: str = "cnt", window_end: str = "window_end"
) -> DataFrame:
    """The ``n`` largest rows per window; ties go to the smaller key.

    The filter on ``row_number`` lets Spark keep only ``n`` rows per window in
    each map task (WindowGroupLimit), before anything is shuffled.
    """
    order = Window.partitionBy(window_end).orderBy(F.desc(by), *[F.asc(k) for k in keys])
    return counts.withColumn("row_num", F.row_number().over(order)).where(F.col("row_num") <= n)


def top_n_sql(spark: SparkSession, view: str, n: int, key: str) -> DataFrame:
    """``top_n`` as SQL text over a registered view with ``window_end`` and ``cnt``."""
    return spark.sql(
        f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key} ASC) AS row_num
          FROM {view}
        ) WHERE row_num <= {int(n)}
        """
    )


def ranking_report(top: DataFrame, line: Column, window_end: str = "window_end") -> DataFrame:
    """One text per window: its end, then ``line`` for each rank. Expects ``top_n`` output."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_num", line.alias("_line")))), lambda r: r["_line"])
    header = F.concat(F.lit("window end "), F.date_format(window_end, "yyyy-MM-dd HH:mm:ss"))
    return (
        top.groupBy(window_end)
        .agg(F.array_join(lines, "\n").alias("_lines"))
        .select(window_end, F.concat_ws("\n", header, "_lines").alias("report"))
    )
