"""Repeated lines: a sharded minimal perfect hash over their hashes indexes compact arrays that documents probe.

A line's key is the line without blanks at its ends, with A-Z in lower case. Keys of at least ``LEAST_CHARS`` code points
found in at least ``LEAST_DOCS`` documents lose all their lines, except those of the largest doc_id that holds them.

1. Tasks hash the keys of whole texts (128 bits, each key once per document). Counts and the largest doc_id are combined
   in the map tasks, so a line that a third of all documents hold costs one row per task.
2. Keys with enough documents are dealt to shards by hash, as many as keep a shard near ``SHARD_KEYS``. One task builds a
   shard: bit levels in which each key seeks a place of its own, ranked by popcounts (``LineIndex``), and beside them,
   in rank order, 64-bit fingerprints, document counts and the keeping doc_id. A shard is one row of a written table.
3. Documents probe the arrays where they are: while all shards together measure at most ``ARRAY_BYTES`` every task gets
   them, and no text moves. Beyond that the narrow hashes travel to the shards instead: a shard's row and its probes meet in
   one partition, the row first, so a task holds one shard and streams the rest; a shard that many documents probe is
   copied to several partitions by its own counts. Both ways give the same rows.

A false drop needs two lines that agree in 128 bits. Null and empty texts are one empty line. Documents are rows: a repeated
row counts again, and each of the rows with the keeping doc_id keeps its lines. A null doc_id is smaller than any other; if
no document of a line has one, all keep it. Columns of other names are kept; of clashing names, replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import all_of, keep, slices

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Keys of a shard, about: its task holds them and a few numbers for each.
SHARD_KEYS = 1 << 17
#: Arrays of this many bytes at most are sent to every task.
ARRAY_BYTES = 64 << 20
#: Probes of a shard that meet in one partition, about.
PARTITION_PROBES = 2_000_000
BLANK = b" \t\n\x0b\x0c\r"
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: A key that shares its place on this many levels with others is not one of distinct hashes.
MOST_LEVELS = 500
MADE = "n_lines bigint, n_dropped bigint, kept_text string"


def key_of(line: bytes) -> bytes | None:
    """The key of a line long enough to count, in UTF-8."""
    key = line.strip(BLANK)
    if len(key) < LEAST_CHARS or not key.isascii() and len(key.decode(errors="replace")) < LEAST_CHARS:
        return None
    return key.lower()


def hashed(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2)
    return pairs[:, 0].astype(np.uint64), pairs[:, 1].astype(np.uint64)


def shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    return (high >> np.uint64(33)).astype(np.int64) % shards


class LineIndex:
    """A minimal perfect hash over pairs of 64-bit hashes, with a fingerprint, a count and a keeper for each."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray, keepers: np.ndarray, known: np.ndarray):
        self.sizes, self.bits, self.fingerprints = sizes, bits, fingerprints
        self.counts, self.keepers, self.known = counts, keepers, known
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.directory = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @staticmethod
    def place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        x = high ^ (low + np.uint64(level)) * MIX[0]
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, keepers: np.ndarray, known: np.ndarray) -> LineIndex:
        sizes, levels, rest = [], [], np.arange(len(high))
        while len(rest):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("hashes are not distinct")
            size = -(-max(len(rest), 64) // 64) * 64
            at = cls.place(high[rest], low[rest], len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            taken = np.zeros(size, bool)
            taken[at[alone]] = True
            sizes.append(size)
            levels.append(np.packbits(taken, bitorder="little").view("<u8"))
            rest = rest[~alone]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        index = cls(np.array(sizes, np.int64), bits, low, counts, keepers, known)
        order = np.argsort(index.ranks(high, low))
        return cls(index.sizes, bits, low[order], counts[order], keepers[order], known[order])

    def ranks(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Each pair's number, or -1 where no level holds it. A pair that was not built in may get any number."""
        found, open_ = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.starts[level] + self.place(high[open_], low[open_], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.bits[word] & ~(~np.uint64(0) << bit))
            found[open_[held]] = (self.directory[word] + below)[held]
            open_ = open_[~held]
        return found

    def probe(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Each pair's number if its fingerprint is there, else -1."""
        at = self.ranks(high, low)
        same = at >= 0
        same[same] = self.fingerprints[at[same]] == low[same]
        return np.where(same, at, -1)

    def dropped(self, high: np.ndarray, low: np.ndarray, docs: np.ndarray, given: np.ndarray) -> np.ndarray:
        """Which keys their documents lose: those found, unless the document is the one that keeps them.

        ``given`` tells which of ``docs`` are not null.
        """
        at = self.probe(high, low)
        keeps = np.where(given, self.known[at] & (self.keepers[at] == docs), ~self.known[at])
        return (at >= 0) & ~keeps

    def arrays(self) -> dict[str, bytes]:
        kinds = {"sizes": "<i8", "bits": "<u8", "fingerprints": "<u8", "counts": "<i8", "keepers": "<i8", "known": "?"}
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in kinds.items()}

    @classmethod
    def of(cls, row) -> LineIndex:
        kinds = {"sizes": "<i8", "bits": "<u8", "fingerprints": "<u8", "counts": "<i8", "keepers": "<i8", "known": "?"}
        return cls(**{name: np.frombuffer(row[name], kind) for name, kind in kinds.items()})


ARRAYS = "sizes binary, bits binary, fingerprints binary, counts binary, keepers binary, known binary"


def _packed(docs: DataFrame, text: str, id: str, *more: Column) -> DataFrame:
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id}`").cast("bigint").alias("doc"), value.alias("text"), *more)


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[bytes]]]:
    """A batch in row ranges of bounded text, each with its texts as bytes."""
    texts = batch.column(column)
    for low, high in slices(texts):
        yield low, high, texts.slice(low, high - low).cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def line_counts(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``high, low, n, keeper``: each key's hash, its documents and the largest doc_id among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in _texts(batch, "text"):
                ids = batch.column("doc").slice(low, high - low)
                keys, owners = [], []
                for at, value in enumerate(texts):
                    found = {key_of(line) for line in value.split(b"\n")}
                    found.discard(None)
                    keys.extend(found)
                    owners.extend([at] * len(found))
                first, second = hashed(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), ids.take(pa.array(owners, pa.int64()))], names=["high", "low", "doc"]
                )

    lines = _packed(docs, text, id).mapInArrow(run, "high bigint, low bigint, doc bigint")
    return lines.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))


def line_index(counts: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, int]:
    """The written table of shards over all keys with ``least_docs`` documents, and how many shards there are."""
    repeated = keep(counts.where(F.col("n") >= least_docs), "repeated")
    shards = -(-repeated.count() // SHARD_KEYS)

    def build(table: pa.Table) -> pa.Table:
        high, low = (table.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        keepers, known = table.column("keeper").fill_null(0).to_numpy(), table.column("keeper").is_valid().to_numpy()
        index = LineIndex.build(high, low, table.column("n").to_numpy(), keepers, known)
        return pa.Table.from_pylist([{"shard": table.column("shard")[0].as_py(), **index.arrays(), "probes": int(index.counts.sum())}], schema=kinds)

    kinds = pa.schema([("shard", pa.int64()), *[(c.split()[0], pa.binary()) for c in ARRAYS.split(", ")], ("probes", pa.int64())])
    shard = F.shiftrightunsigned("high", 33) % F.lit(max(1, shards))
    built = repeated.withColumn("shard", shard).groupBy("shard").applyInArrow(build, f"shard bigint, {ARRAYS}, probes bigint")
    return keep(built, "line-index"), shards


def drop_repeated_lines(docs: DataFrame, text: str = "text", id: str = "doc_id", least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``, the text without the lines it loses."""
    index, shards = line_index(line_counts(docs, text, id), least_docs)
    names = [c.split()[0] for c in ARRAYS.split(", ")]
    size = index.agg(F.sum(sum((F.octet_length(c) for c in names), F.lit(0)))).first()[0] or 0
    packed = _packed(docs, text, id, all_of(docs).alias("row"))
    if size <= ARRAY_BYTES:
        made = _probed_in_place(packed, index, shards)
    else:
        made = _probed_at_shards(packed, index, shards)
    added = [c.split()[0] for c in MADE.split(", ")]
    kept = [c for c in docs.columns if c not in added]
    return made.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col("made").getField(c).alias(c) for c in added])


def _answer_schema(packed: DataFrame) -> StructType:
    return StructType([packed.schema["row"], StructField("made", StructType.fromDDL(MADE))])


def _answered(batch: pa.RecordBatch, losing) -> Iterator[pa.RecordBatch]:
    """Rows with their kept text. ``losing(rows, keys)`` tells for each key whether the document in that row loses it."""
    for low, high, texts in _texts(batch, "text"):
        split, rows, asked = [], [], []
        for at, value in enumerate(texts, low):
            lines = value.split(b"\n")
            keys = [key_of(line) for line in lines]
            split.append((lines, keys))
            long = {key for key in keys if key is not None}
            rows.extend([at] * len(long))
            asked.extend(long)
        lost: dict[int, set[bytes]] = {}
        for number in np.flatnonzero(losing(np.array(rows, np.int64), asked)).tolist():
            lost.setdefault(rows[number], set()).add(asked[number])
        n_lines, n_dropped, kept = [], [], []
        for at, (lines, keys) in enumerate(split, low):
            gone = lost.get(at)
            stay = [line for line, key in zip(lines, keys) if key not in gone] if gone else lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay))
        made = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        rows_ = batch.column("row").slice(low, high - low)
        yield pa.RecordBatch.from_arrays([rows_, pa.StructArray.from_arrays(made, names=["n_lines", "n_dropped", "kept_text"])], names=["row", "made"])


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids with 0 for nulls, and which are not null."""
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def _probed_in_place(packed: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Every task holds all arrays, which were measured."""
    sent = packed.sparkSession.sparkContext.broadcast({r["shard"]: r.asDict() for r in index.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = {shard: LineIndex.of(row) for shard, row in sent.value.items()}
        for batch in batches:
            docs, given = _ids(batch.column("doc"))

            def losing(rows: np.ndarray, keys: list[bytes]) -> np.ndarray:
                high, low = hashed(keys)
                gone = np.zeros(len(keys), bool)
                of = shard_of(high, max(1, shards))
                for shard, index_ in indexes.items():
                    mine = np.flatnonzero(of == shard)
                    gone[mine] = index_.dropped(high[mine], low[mine], docs[rows[mine]], given[rows[mine]])
                return gone

            yield from _answered(batch, losing)

    return packed.mapInArrow(run, _answer_schema(packed))


def _probed_at_shards(packed: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Hashes go to the arrays, and what they find comes back by document; texts with finds move once."""
    mark = F.struct("doc", F.xxhash64("text").alias("digest"), F.octet_length("text").alias("bytes"))
    marked = packed.withColumn("mark", mark)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in _texts(batch, "text"):
                keys, owners = [], []
                for at, value in enumerate(texts, low):
                    found = {key_of(line) for line in value.split(b"\n")}
                    found.discard(None)
                    keys.extend(found)
                    owners.extend([at] * len(found))
                first, second = hashed(keys)
                marks = batch.column("mark").take(pa.array(owners, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard_of(first, shards)), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), marks], names=["shard", "high", "low", "mark"]
                )

    at = StructType.fromDDL("shard bigint, high bigint, low bigint").add(marked.select("mark").schema["mark"])
    copies = F.ceil(F.col("probes") / PARTITION_PROBES).cast("int")
    asked = marked.select("text", "mark").mapInArrow(ask, at)
    asked = asked.join(index.select("shard", copies.alias("copies")), "shard").withColumn("copy", F.pmod(F.xxhash64("mark"), "copies").cast("int")).drop("copies")
    names = [c.split()[0] for c in ARRAYS.split(", ")]
    shelves = index.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("probes")
    met = shelves.unionByName(asked, allowMissingColumns=True)
    # A shard's own row has no mark and sorts before its probes.
    met = met.repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("mark").isNotNull())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            shard, copy, marked_ = batch.column("shard").to_numpy(), batch.column("copy").to_numpy(), batch.column("mark").is_valid().to_numpy(zero_copy_only=False)
            cuts = [0, *np.flatnonzero(~marked_).tolist(), len(shard)]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                if low < high and not marked_[low]:
                    held = (shard[low], copy[low], LineIndex.of({n: part.column(n)[0].as_py() for n in names}))
                    part = part.slice(1)
                if part.num_rows == 0:
                    continue
                first, second = (part.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
                gone = held[2].dropped(first, second, *_ids(part.column("mark").field("doc")))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(gone)) for c in ("mark", "high", "low")], names=["mark", "high", "low"])

    found = met.mapInArrow(answer, StructType([at["mark"], at["high"], at["low"]]))
    lost = keep(found.groupBy("mark").agg(F.collect_set(F.struct("high", "low")).alias("lost")), "lost")
    same = marked["mark.doc"].eqNullSafe(F.col("l.mark.doc")) & (marked["mark.digest"] == F.col("l.mark.digest")) & (marked["mark.bytes"] == F.col("l.mark.bytes"))
    joined = marked.join(lost.alias("l"), same, "left").select("row", "doc", marked["text"].alias("text"), F.col("l.lost").alias("lost"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("lost")

            def losing(rows: np.ndarray, keys: list[bytes]) -> np.ndarray:
                gone = {at: {(p["high"], p["low"]) for p in lists[at].as_py() or ()} for at in np.unique(rows).tolist()}
                first, second = (h.view(np.int64).tolist() for h in hashed(keys))
                return np.array([pair in gone[at] for at, pair in zip(rows.tolist(), zip(first, second))], bool)

            yield from _answered(batch, losing)

    return joined.mapInArrow(run, _answer_schema(packed))


def line_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256``: one row per document."""
    got = drop_repeated_lines(docs.select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
