"""Uniform shuffling into shards by a two-pass external shuffle, in DataFrame expressions only.

First pass: every record is scattered by a seeded hash of its content into one of so many buckets that a bucket fits in a
task's memory. Second pass: each bucket is gathered, put in a canonical order and shuffled by Fisher-Yates
(``shuffle`` with a seed). A record's place in its bucket plus the sizes of the buckets before it is its rank in one
permutation of all records; shards are stretches of ranks that differ by one record at most, so a bucket holds one range of
one shard, or a few, and is written as it was gathered: whole records move once and are stored once.

Equal records are told apart by a copy number, so that even one record repeated without end spreads over all buckets.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import keep, scratch, small

SEED = 20240229
#: Small records of a bucket, on average (an id, sizes, a digest), some tens of bytes.
BUCKET_ROWS = 20_000
#: Bytes of whole records that one bucket, or one range of a shard, is to hold; the bytes are measured.
BUCKET_BYTES = 16 << 20


def shuffled(records: DataFrame, shards: int, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``records`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0 up without gaps in each shard).

    The result depends on the records, ``shards``, ``seed`` and ``bucket_rows`` alone, not on partitions or order: all
    columns take part in the hash and in the canonical order, nulls included. Repeated records each get a slot of
    their own; an empty frame gives an empty frame. Columns must be sortable, so not maps; one named ``shard`` or ``slot``,
    in any case, gets underscores behind its name.
    """
    records = without_clashes(records)
    packed = records.select(F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record"))
    # Only records whose digest occurs again are grouped as a whole to number their copies.
    marked = packed.withColumn("digest", F.xxhash64("record"))
    again = small(keep(marked.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "repeated"))
    copies = keep(marked.join(again, "digest", "left_semi").groupBy("digest", "record").agg(F.count("*").alias("times")), "copies")
    numbered = copies.select("digest", "record", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("copy"))
    once = marked.join(again, "digest", "left_anti").select("digest", "record", F.lit(1).cast("bigint").alias("copy"))
    n = records.count()
    buckets = max(1, math.ceil(n / bucket_rows))
    key = F.xxhash64(F.lit(seed), F.col("digest"), F.col("copy"))
    # The bucket takes the upper bits of the key; the order within it all of them, then the record.
    bucket = F.pmod(F.shiftrightunsigned("key", 20), F.lit(buckets)).cast("int")
    scattered = once.unionByName(numbered).select("record", "copy", key.alias("key")).withColumn("bucket", bucket)
    # Buckets are counted by the digests alone, so ranks are known when a bucket is gathered and records move only once.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket, that is per some ten thousand records.
    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    offsets = keep(sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    gathered = scattered.repartitionById(buckets, "bucket").groupBy("bucket").agg(F.collect_list(F.struct("key", "record", "copy")).alias("all"))
    # One order of buckets in a task and of records in a bucket, so a task that runs again draws the same numbers.
    ordered = gathered.withColumn("all", F.array_sort("all")).sortWithinPartitions("bucket")
    drawn = ordered.select("bucket", F.shuffle("all", F.lit(seed)).alias("all")).join(small(offsets), "bucket")
    placed = drawn.select("offset", F.posexplode("all").alias("at", "drawn"))
    rank = F.col("offset") + F.col("at")
    # The first shards hold one record more than the others.
    each, longer = divmod(n, shards)
    edge = longer * (each + 1)
    shard = F.when(rank < edge, F.floor(rank / (each + 1))).otherwise(longer + F.floor((rank - edge) / max(1, each)))
    slot = F.when(rank < edge, rank % (each + 1)).otherwise((rank - edge) % max(1, each))
    return placed.select("drawn.record.*", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))


def without_clashes(records: DataFrame) -> DataFrame:
    """``records`` with other names for columns called like those that are added."""
    taken = {c.lower() for c in records.columns}
    names = []
    for name in records.columns:
        if name.lower() in ("shard", "slot"):
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        names.append(name)
    return records.toDF(*names)


def bucket_rows_for(docs: DataFrame) -> int:
    """How many records of average measured size make BUCKET_BYTES."""
    measured = docs.select(F.octet_length(F.to_json(F.struct("*"))).cast("bigint").alias("bytes")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    return max(1, min(BUCKET_ROWS, BUCKET_BYTES * measured["n"] // max(1, measured["bytes"] or 0)))


def shard_plan(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """Per document ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, read from the shards that were written.

    The law is ``rows``: counts of shards differ by one at most. A null text has size 1 and the checksum of an empty
    text; documents without an id are dealt like others. ``grown_shard`` belongs to another law and is null. Whole
    records go through both passes and are left in the shared folder.
    """
    path = f"{scratch(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    written = write_shards(docs, path, shards, seed)
    content = F.coalesce(F.col("text"), F.lit(""))
    sizes = (F.octet_length(content) + 1).cast("bigint").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32")
    return written.select("doc_id", *sizes, F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = SEED, bucket_rows: int | None = None) -> DataFrame:
    """Whole records shuffled and written to ``path``, one folder per shard, each in slot order; returns what was written.

    Without ``bucket_rows`` buckets are sized by the measured bytes of the records. Each task writes a bucket, which is a range
    of one shard, or ends one shard and begins the next.
    """
    docs = without_clashes(docs)
    dealt = shuffled(docs, shards, seed, bucket_rows or bucket_rows_for(docs))
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    schema = StructType([*docs.schema, StructField("slot", LongType()), StructField("shard", IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)
