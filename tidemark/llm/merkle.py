"""A Merkle manifest of a dataset: leaf places from ranked bitmaps, levels reduced in slot arrays.

Every row is a leaf. The leaves of a group ascend by id; runs of eight consecutive nodes become their digest until one
is left, the group's subroot; the subroots, ordered by group, become the root in the same way.

No step sorts the leaves. The ids of a group are bits of a bitmap compressed to its non-empty 64-bit words. A directory of
popcounts (sums over pages of 4,096 words, then over pages of pages, as many levels as the range of ids asks for) gives the
number of ids before a word, and the popcount of the word below its own bit the rest: that rank is the leaf's place.
Places make keys: (group, place div 512) gathers one block of at most 512 nodes, laid into an array by slot, and an array
yields three levels at once. Blocks are written; paths come down from the root, one join of block rows for three levels.

Everything here is a DataFrame expression. A task holds one block, or one page of words, at a time.

Nulls: a null group is its own group and comes first. A null id comes before all others of its group. Rows with equal ids
(their surplus is the difference between a word's count and its popcount) follow one another by leaf; rows that are equal in
both are interchangeable. No rows give no manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import all_of, keep

#: Nodes that become one node of the next level.
FAN = 8
#: Levels reduced within one block, and its slots.
LEVELS = 3
SLOTS = FAN**LEVELS
#: Words (or pages) of one page of the directory, as a power of two.
PAGE_BITS = 12
#: The word of rows without an id: before the word of the least id.
NO_ID = -(1 << 57) - 1
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    """A field as it enters a digest: ``-`` if null, else its bytes' number, a colon and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings give."""
    return F.aggregate(path, start, lambda got, step: F.sha2(F.concat(step["before"], got, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(rows: DataFrame, group: str, id: str, digest: str) -> DataFrame:
    """``rows`` (ids and digests, not texts) with ``subroot``, ``root`` and ``path`` from the leaf to the root.

    A step of the path holds the joined siblings ``before`` and ``after`` the node. Columns of these names are replaced.
    """
    named = F.col(f"`{group}`").cast("string")
    # Orders as the group's bytes do, null first.
    key = F.when(named.isNull(), "-").otherwise(F.concat(F.lit(":"), named))
    base = keep(rows.select(key.alias("g"), F.col(f"`{id}`").cast("bigint").alias("i"), F.col(f"`{digest}`").alias("h"), all_of(rows).alias("row")), "leaves")
    trees = tree(places(base))
    tops = keep(trees.select("g", F.col("top").alias("h")).distinct(), "subroots")
    roots = tree(numbered(tops)).select(F.col("row.g").alias("g"), F.col("top").alias("root"), F.col("path").alias("above"))
    whole = trees.join(roots, "g").select("row", F.col("top").alias("subroot"), "root", F.concat("path", "above").alias("path"))
    kept = [c for c in rows.columns if c.lower() not in ("subroot", "root", "path")]
    return whole.select(*[F.col("row").getField(c).alias(c) for c in kept], "subroot", "root", "path")


def places(base: DataFrame) -> DataFrame:
    """``base`` (g, i, h, row) with ``place``, the leaf's number in its group, and ``n``, the group's leaves."""
    base = base.withColumns({"word": F.coalesce(F.shiftright("i", 6), F.lit(NO_ID)), "bit": F.coalesce(F.col("i").bitwiseAND(63), F.lit(0)).cast("int")})
    bits = F.bit_or(F.expr("shiftleft(1L, bit)"))
    words = keep(base.groupBy("g", "word").agg(bits.alias("bits"), F.count("*").alias("rows")), "words")
    sizes = words.groupBy("g").agg(F.sum("rows").alias("n"))
    ranked = keep(before(words, "word").join(sizes, "g"), "ranks")
    met = base.join(ranked, ["g", "word"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    surplus = F.col("rows") > F.bit_count("bits")
    out = ["g", "h", "row", "n", "place"]
    single = met.where(~surplus).withColumn("place", F.col("before") + below).select(*out)
    if words.where(surplus).isEmpty():
        return single
    # Words with repeated ids: places by (id, leaf), in pieces by the leaf's first digits so that no window is large.
    tied = met.where(surplus).withColumn("piece", F.substring("h", 1, 3))
    piece = ["g", "word", "i", "piece"]
    counts = tied.groupBy(*piece).agg(F.count("*").alias("m"))
    earlier = Window.partitionBy("g", "word").orderBy(F.col("i").asc_nulls_first(), "piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("m").over(earlier), F.lit(0)))
    counts = counts.select("g", "word", F.coalesce("i", F.lit(0)).alias("i0"), "piece", "earlier")
    within = F.row_number().over(Window.partitionBy(*piece).orderBy("h"))
    several = tied.withColumns({"within": within - 1, "i0": F.coalesce("i", F.lit(0))}).join(counts, ["g", "word", "i0", "piece"])
    return single.unionByName(several.withColumn("place", F.col("before") + F.col("earlier") + F.col("within")).select(*out))


def before(counts: DataFrame, key: str) -> DataFrame:
    """``counts`` (g, key, rows, …) with ``before``, the rows of smaller keys of the group: the popcount directory."""
    low, high = counts.agg(F.min(key), F.max(key)).first()
    whole = low is None or high - low < 1 << PAGE_BITS
    over = F.lit(0) if whole else F.shiftright(key, PAGE_BITS)
    inside = Window.partitionBy("g", "over").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    paged = counts.withColumn("over", over).withColumn("before", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    if whole:
        return paged.drop("over")
    pages = keep(counts.groupBy("g", over.alias("page")).agg(F.sum("rows").alias("rows")), "pages")
    start = before(pages, "page").select("g", F.col("page").alias("over"), F.col("before").alias("start"))
    return paged.join(start, ["g", "over"]).withColumn("before", F.col("before") + F.col("start")).drop("over", "start")


def numbered(tops: DataFrame) -> DataFrame:
    """All subroots as one group, placed by the order of their groups: range partitions, counted, then added up."""
    parts = tops.repartitionByRange("g").sortWithinPartitions("g").withColumn("at", F.monotonically_increasing_id())
    parts = keep(parts.select("g", "h", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at")), "ordered")
    sizes = parts.groupBy(F.lit("").alias("g"), "part").agg(F.count("*").alias("rows"))
    starts = before(sizes, "part").select("part", F.col("before").alias("start"))
    whole = parts.groupBy().agg(F.count("*").alias("n"))
    total = whole.first()[0]
    return parts.join(starts, "part").select(
        F.lit("").alias("g"), "h", F.struct("g").alias("row"), F.lit(total).alias("n"), (F.col("start") + F.col("at")).alias("place")
    )


def tree(placed: DataFrame) -> DataFrame:
    """``g, row, top, path`` for every node placed (g, place, n, h, row): the top of its group and the steps to it."""
    # Levels to the top: the digits of n - 1 in the base FAN.
    depth = F.when(F.col("n") <= 1, 0).otherwise(F.length(F.conv((F.col("n") - 1).cast("string"), 10, FAN)))
    nodes = placed.select("g", "place", "h", "row", depth.cast("int").alias("depth"))
    tiers: list[DataFrame] = []
    while True:
        block = F.floor(F.col("place") / SLOTS)
        slots = F.array_sort(F.collect_list(F.struct((F.col("place") % SLOTS).alias("slot"), "h", "row")))
        blocks = nodes.groupBy("g", block.cast("bigint").alias("block"), "depth").agg(slots.alias("slots"))
        blocks = keep(_levels(blocks), f"tier{len(tiers)}")
        tiers.append(blocks)
        higher = blocks.where(F.col("depth") > LEVELS)
        if higher.isEmpty():
            break
        nodes = higher.select("g", F.col("block").alias("place"), F.col("node").alias("h"), F.struct(F.col("block").alias("at")).alias("row"), (F.col("depth") - LEVELS).alias("depth"))
    above: DataFrame | None = None
    for blocks in reversed(tiers):
        step = "array<struct<before:string,after:string>>"
        ended = blocks.where(F.col("depth") <= LEVELS).select(*blocks.columns, F.col("node").alias("top"), F.array().cast(step).alias("rest"))
        if above is not None:
            upper = above.select("g", F.col("row.at").alias("block"), "top", F.col("path").alias("rest"))
            ended = ended.unionByName(blocks.where(F.col("depth") > LEVELS).join(upper, ["g", "block"]))
        above = ended.select("g", "top", F.inline(_paths()))
    return above


def _levels(blocks: DataFrame) -> DataFrame:
    """A block with its nodes after no, one and two levels (``l0``, ``l1``, ``l2``) and its ``node`` after the last it has."""
    runs = lambda nodes: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")),
        lambda run: F.sha2(F.array_join(F.slice(nodes, run * FAN + 1, FAN), ""), 256),
    )
    blocks = blocks.withColumn("l0", F.transform("slots", lambda s: s["h"]))
    for level in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"l{level}", runs(F.col(f"l{level - 1}")))
    last = F.least("depth", F.lit(LEVELS))
    node = F.coalesce(*[F.when(last == level, F.col(f"l{level}")[0]) for level in range(LEVELS + 1)])
    return blocks.withColumn("node", node).drop(f"l{LEVELS}")


def _paths() -> Column:
    """Every slot's row with the steps within its block and above it."""

    def step(level: int, slot: Column) -> Column:
        nodes, at = F.col(f"l{level}"), F.floor(slot / FAN**level).cast("int")
        place = at % FAN
        return F.struct(
            F.array_join(F.slice(nodes, at - place + 1, place), "").alias("before"),
            F.array_join(F.slice(nodes, at + 2, F.lit(FAN - 1) - place), "").alias("after"),
        )

    def path(slot: Column, at: Column) -> Column:
        within = F.slice(F.array(*[step(level, at) for level in range(LEVELS)]), F.lit(1), F.least("depth", F.lit(LEVELS)))
        return F.struct(slot["row"].alias("row"), F.concat(within, F.col("rest")).alias("path"))

    return F.transform("slots", path)


def tamper_evidence(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` and what a check of tampered copies finds: one row per document.

    Where 3 divides the CRC-32 of the decimal id, the copy's text has A-Z in lower case. Its recomputed leaf is folded with
    the original siblings; ``verified`` says whether that gives the root. A null id is never tampered with.
    """
    fields = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    struck = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", LETTERS, LETTERS.lower())
    rows = docs.select(
        "doc_id", "lang", leaf(fields(F.col("text"))).alias("leaf"),
        F.when(F.coalesce(struck, F.lit(False)), leaf(fields(lowered))).alias("copy"),
    )
    proved = manifest(rows, "lang", "doc_id", "leaf")
    folded = fold(F.coalesce("copy", "leaf"), F.col("path"))
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
