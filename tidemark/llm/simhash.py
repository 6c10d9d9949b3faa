"""Near-duplicates by SimHash fingerprints over an inverted index of byte positions with count filtering.

Two fingerprints of 8 bytes that differ in at most 4 bits agree in at least 4 byte positions. Postings are kept for
sets of three positions with their bytes rather than for single ones: 20 such sets suffice for any 4 positions to
contain one (``POSITION_SETS``), and a posting then holds fingerprints that agree in 24 bits, not 8. For every pair
that meets in a posting all agreeing positions are tallied; pairs with the guaranteed 4 are verified bit by bit.

Equal fingerprints are one node. Components need only enough links to hold together, not all: the members of a
posting are first compared with a few leaders, a linear number of pairs that ties dense groups of copies together.
Only where a posting still holds several components are its members outside its largest component compared with all
others, so no link between different components is missed and no group is expanded into all its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import add_columns, all_of, keep
from .components import components

SEED = 42
SHINGLE = 4
MOST_BITS = 4
LEADER_ROUNDS = 3
SHINGLES_AT_ONCE = 1 << 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def position_sets() -> list[tuple[int, ...]]:
    """Triples of the 8 byte positions such that any 4 positions contain one.

    The positions form three groups; triples lie within a group, or two in one and one in the next group. Of any 4
    positions, 3 are in one group, or 2 and 2, or 2, 1 and 1: each has such a triple.
    """
    group = [p * 3 // 8 for p in range(8)]

    def taken(triple: tuple[int, ...]) -> bool:
        groups = sorted(group[p] for p in triple)
        if groups[0] == groups[2]:
            return True
        if len(set(groups)) == 3:
            return False
        twice = groups[1]
        once = groups[0] if groups[2] == twice else groups[2]
        return once == (twice + 1) % 3

    return [t for t in combinations(range(8), 3) if taken(t)]


POSITION_SETS = position_sets()


def fingerprint(text: str) -> int:
    """64-bit SimHash of word shingles: bit set if set in more than half the hashes; zero without words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
    width = min(SHINGLE, len(words))
    total = len(words) - width + 1
    starts = np.concatenate([[0], ends[: total - 1]]).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for low in range(0, total, SHINGLES_AT_ONCE):
        cut = slice(low, low + SHINGLES_AT_ONCE)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[cut], stops[cut], strict=True)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long; null and wordless texts get zero."""

    def start():
        return lambda texts: [[fingerprint(t) for t in texts]]

    return add_columns(docs, text, StructType([StructField(name, LongType())]), start)


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def _close(a: Column, b: Column) -> Column:
    """Tally of agreeing positions reaches the guaranteed minimum, then the differing bits are counted."""
    differing = a.bitwiseXOR(b)
    tally = sum((_byte(differing, p) == 0).cast("int") for p in range(8))
    return (tally >= 8 - MOST_BITS) & (F.bit_count(differing) <= MOST_BITS)


def postings(nodes: DataFrame, value: str) -> DataFrame:
    """``posting, value``: each fingerprint under its bytes at each set of positions."""
    keys = []
    for k, (p, q, r) in enumerate(POSITION_SETS):
        x = F.col(value)
        packed = F.shiftleft(_byte(x, p), 16).bitwiseOR(F.shiftleft(_byte(x, q), 8)).bitwiseOR(_byte(x, r))
        keys.append(packed + F.lit(k << 24).cast("bigint"))
    return nodes.select(F.explode(F.array(*keys)).alias("posting"), F.col(value).alias("value"))


def close_components(nodes: DataFrame, value: str) -> DataFrame:
    """``value, root`` for distinct non-null longs; chains of links of at most MOST_BITS bits lead to the same root."""
    every = postings(nodes, value)
    shared = every.groupBy("posting").agg(F.count("*").alias("n")).where("n > 1").select("posting")
    members = keep(every.join(shared, "posting"), "postings")
    labels: DataFrame | None = None
    for round_ in range(LEADER_ROUNDS):
        order = F.xxhash64("value", F.lit(round_))
        leaders = members.groupBy("posting").agg(F.min_by("value", order).alias("first"), F.max_by("value", order).alias("last"))
        met = members.join(leaders, "posting")
        # Leaders stay columns; only verified links leave, each once for a value and a leader.
        links = [
            met.where((F.col("value") != F.col(leader)) & _close(F.col("value"), F.col(leader))).select(
                F.least("value", leader).alias("a"), F.greatest("value", leader).alias("b")
            )
            for leader in ("first", "last")
        ]
        labels = _relabelled(labels, links[0].unionByName(links[1]).distinct())
        members = _undecided(members.select("posting", "value"), labels)
    named = members.withColumnRenamed("root", "label")
    largest = named.groupBy("posting", "label").count().groupBy("posting").agg(F.max_by("label", F.struct("count", "label")).alias("most"))
    others = named.join(largest, "posting").where("label <> most").select("posting", F.col("value").alias("other"), F.col("label").alias("other_label"))
    pairs = others.join(named, "posting").where((F.col("label") != F.col("other_label")) & _close(F.col("value"), F.col("other")))
    labels = _relabelled(labels, pairs.select(F.col("value").alias("a"), F.col("other").alias("b")))
    wanted = nodes.select(F.col(value).alias("value"))
    roots = labels.select(F.col("node").alias("value"), "root")
    return wanted.join(roots, "value", "left").select("value", F.coalesce("root", "value").alias("root"))


def _relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots after further links; roots are the smallest members."""
    if labels is None:
        return components(links, "a", "b")
    known = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(known.unionByName(links.select("a", "b")), "a", "b")


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``posting, value, root``: members of postings that hold more than one component."""
    named = members.join(labels.select(F.col("node").alias("value"), "root"), "value", "left").withColumn("root", F.coalesce("root", "value"))
    mixed = named.groupBy("posting").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("posting")
    return keep(named.join(mixed, "posting").select("posting", "value", "root"), "postings")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` is the smallest id among all rows reachable over links, itself
    included. Null or empty texts have fingerprint zero and link like any other; rows without an id take part and
    get the smallest id of their component (null if it has none); repeated rows stay repeated; an empty frame gives an
    empty frame; other columns are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = keep(with_fingerprints(rows).select("doc_id", "fingerprint"), "fingerprints")
    roots = fingerprint_components(prints)
    joined = prints.join(roots, "fingerprint")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """``fingerprint, root, component_id`` for each distinct fingerprint of kept rows ``doc_id, fingerprint``."""
    nodes = keep(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest")), "nodes")
    roots = close_components(nodes, "fingerprint").withColumnRenamed("value", "fingerprint")
    rooted = keep(nodes.join(roots, "fingerprint"), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    return keep(rooted.join(lowest, "root").select("fingerprint", "root", "component_id"), "components")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (rows without an id come last).

    Rows that tie, such as repeated ones, are told apart by their place in the input. Columns are those of ``docs``.
    """
    packed = docs.select(
        all_of(docs).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    printed = keep(with_fingerprints(packed).drop("text").withColumn("place", F.monotonically_increasing_id()), "printed")
    roots = fingerprint_components(printed.select("doc_id", "fingerprint"))
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "place")
    placed = printed.select("doc_id", "fingerprint", "place").join(roots, "fingerprint")
    chosen = placed.groupBy("root").agg(F.min(rank).alias("kept")).select(F.col("kept.place").alias("place"))
    return printed.join(chosen, "place", "left_semi").select("row.*")
