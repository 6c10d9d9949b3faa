"""A table with one row per key that batches change: immutable folders and a manifest for each version.

A batch writes its rows to a folder of its own (a delta) and then commits: version ``n`` is one small file that lists the
folders that make up the table after batch ``n``, a base and later deltas. The file appears by a single rename, and folders
of committed versions are never touched, so a batch that dies anywhere leaves the version before it whole, and a repeated
batch builds the same version again. Reading takes the newest row of each key; map tasks combine first.

When deltas hold half as many rows as the base, or are many, all are merged into a new base: the cost of merging is a
constant factor of the rows written. Replaced folders are emptied two versions later. Rows are dealt by bucket for writing
and large buckets are split over tasks. A batch must hold a key once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
MANIFEST = "folder STRING, version BIGINT, rows BIGINT, base BOOLEAN, retired BIGINT, keys STRING, row_schema STRING"
#: Deltas beside a base, at most.
MOST_DELTAS = 16


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _version(path: str, number: int) -> str:
    return f"{path}/manifest/version={number}"


def _listed(spark: SparkSession, path: str, version: int) -> list[dict]:
    """The folders of a version: a base, at most ``MOST_DELTAS`` deltas, and those replaced of late."""
    if version < 0:
        return []
    return [r.asDict() for r in spark.read.schema(MANIFEST).parquet(_version(path, version)).collect()]


def _commit(spark: SparkSession, path: str, version: int, folders: list[dict]) -> None:
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    listed = spark.createDataFrame([tuple(f[n] for n in names) for f in folders], MANIFEST)
    listed.coalesce(1).write.mode("overwrite").parquet(_version(path, version))


def _read(spark: SparkSession, path: str, folder: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(folder["row_schema"]))
    return spark.read.schema(schema).parquet(f"{path}/data/{folder['folder']}")


def _merged(spark: SparkSession, path: str, folders: list[dict]) -> DataFrame | None:
    live = [f for f in folders if f["retired"] is None]
    if not live:
        return None
    parts = [_read(spark, path, f).withColumn("_version", F.lit(f["version"])) for f in live]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    if len(parts) == 1:
        return both.drop("_version")
    keys = json.loads(live[0]["keys"])
    values = [c for c in both.columns if c not in (*keys, BUCKET, "_version")]
    newest = both.groupBy(*keys, BUCKET).agg(F.max_by(F.struct(*values), "_version").alias("_row"))
    return newest.select(*keys, "_row.*", BUCKET)


def rows(spark: SparkSession, path: str, version: int | None = None, touched: DataFrame | None = None, bucket: Column | None = None) -> DataFrame | None:
    """The table at a version (the latest, if none is given) with its bucket; None if it has never held a row.

    With ``touched`` and ``bucket`` only the buckets of those rows are read.
    """
    if version is None:
        version = spark.read.parquet(f"{path}/manifest").agg(F.max("version")).first()[0]
    table = _merged(spark, path, _listed(spark, path, version))
    if table is None or touched is None:
        return table
    return table.join(touched.select(bucket.cast("string").alias(BUCKET)).distinct(), BUCKET, "left_semi")


def _write(df: DataFrame, path: str) -> None:
    df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def upsert(batch: DataFrame, path: str, keys: Sequence[str], bucket: Column, version: int) -> None:
    """Make ``version`` of the table: the rows of ``batch`` replace those of their keys in the version before."""
    spark = batch.sparkSession
    if version == 0 and exists(spark, _version(path, 1)):
        raise ValueError(f"{path} holds the table of an earlier stream; take a new folder for a new checkpoint")
    listed = _listed(spark, path, version - 1)
    fresh = batch.withColumn(BUCKET, bucket.cast("string"))
    fresh = fresh.select(*batch.columns, BUCKET)
    entry = {"version": version, "base": False, "retired": None, "keys": json.dumps(list(keys)), "row_schema": fresh.schema.json()}
    delta = {**entry, "folder": f"{version}-delta"}
    _write(fresh, f"{path}/data/{delta['folder']}")
    delta["rows"] = _read(spark, path, delta).count()
    live = [f for f in listed if f["retired"] is None]
    if delta["rows"]:
        delta["base"] = not live
        live.append(delta)
    deltas = [f for f in live if not f["base"]]
    replaced = []
    if deltas and (len(deltas) > MOST_DELTAS or 2 * sum(f["rows"] for f in deltas) > sum(f["rows"] for f in live if f["base"])):
        base = {**entry, "folder": f"{version}-base", "base": True}
        _write(_merged(spark, path, live), f"{path}/data/{base['folder']}")
        base["rows"] = _read(spark, path, base).count()
        replaced, live = [{**f, "retired": version} for f in live], [base]
    old = [f for f in listed if f["retired"] is not None]
    _commit(spark, path, version, [*live, *replaced, *[f for f in old if f["retired"] > version - 2]])
    for gone in (f for f in old if f["retired"] <= version - 2):
        _write(_read(spark, path, gone).limit(0), f"{path}/data/{gone['folder']}")
