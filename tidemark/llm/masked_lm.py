"""Documents scored by masked pseudo-likelihood under a bidirectional window network, in numpy.

Every word is predicted from the words on both sides of it, itself masked; a document's score is the sum of the
conditional log-probabilities of its words.

* Vocabulary: words are counted over the whole corpus. Those used at least sqrt(words of the corpus) / GROWTH times, and
  FREQUENT ones in any case, are tokens of their own, MOST_WORDS at most, so what the driver holds is bounded. The others
  fall into RARE_CLASSES hashed classes, within which a word has the probability (its uses) / (uses of the class), so every
  word counts by its own uses. Rare words are told apart by 64 bits.
* Network: vectors of the WINDOW words before and after, scaled by place, are added and passed through tanh; a softmax over
  groups and one over the members of the group give the probability of the token. It begins at the words' frequencies.
* Training: texts are dealt to copies of about REPLICA_WORDS words by a hash of their rows, and read in the order of that
  hash, so scores do not depend on how the table is cut into files or tasks. A copy is trained on every word of its texts,
  each masked once in a round; copies are averaged in a tree, weighted by their words, and the average starts the next of
  ROUNDS. A copy is streamed: its memory is a block of words, whatever it holds.
* The uses of rare words go to the tasks as sorted arrays if they measure at most BROADCAST_BYTES; else they are joined.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from .common import BLANKS, BROADCAST_BYTES, keep, slices

#: Of the smallest network; a vocabulary of more words has more groups.
GROUPS = 32
TOKENS = GROUPS * GROUPS
RARE_CLASSES = 64
FREQUENT = TOKENS - RARE_CLASSES
#: Own tokens of the largest network.
MOST_WORDS = 128 * 128 - RARE_CLASSES
GROWTH = 4
WINDOW = 2
WIDTH = 24
ROUNDS = 1
BATCH = 4096
STEP = 0.08
SEED = 7
AT_ONCE = 1 << 14
#: Bytes of texts whose words are counted, or encoded, at once.
COUNTED_BYTES = 1 << 25
ENCODED_BYTES = 1 << 24
#: Words of a copy in training, and of the block whose words are mixed.
REPLICA_WORDS = 1 << 22
BLOCK_WORDS = 1 << 18
KEPT_BYTES = 1 << 24
#: Values of the network that are averaged as one row, and rows averaged at once.
CHUNK = 4096
FAN_IN = 256
_TOKEN = np.uint16

_PLACES = [k for k in range(-WINDOW, WINDOW + 1) if k]


def shapes(groups: int) -> dict[str, tuple[int, ...]]:
    """Of the network's arrays; the last vector stands for the edges of a text."""
    return {
        "vectors": (groups * groups + 1, WIDTH),
        "places": (len(_PLACES), WIDTH),
        "shift": (WIDTH,),
        "group": (WIDTH, groups),
        "group_bias": (groups,),
        "member": (groups, WIDTH, groups),
        "member_bias": (groups, groups),
    }


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, uses`` over all texts, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for low, high in slices(texts, COUNTED_BYTES, "binary_length"):
                found = pc.ascii_split_whitespace(texts.slice(low, high - low)).flatten().value_counts()
                yield pa.RecordBatch.from_arrays(found.flatten(), names=["word", "uses"])

    words = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "word string, uses bigint")
    return words.where("word <> ''").groupBy("word").agg(F.sum("uses").alias("uses"))


class Vocabulary:
    """Tokens of words: rank among the frequent ones, else a hashed class; and the log of each class's uses.

    ``rare`` has the uses of the words in the classes. It stays with the driver as a frame; a word it lacks has one use.
    ``uses`` are those of the frequent words; without them training begins at equal probabilities.
    """

    def __init__(self, frequent: list[str], class_uses: dict[int, int], rare: DataFrame | None = None, uses: list[int] | None = None) -> None:
        self.frequent, self.class_uses, self.rare, self.uses = frequent, class_uses, rare, uses
        self.groups = max(GROUPS, math.isqrt(len(frequent) + RARE_CLASSES - 1) + 1)
        self.first_class = self.groups**2 - RARE_CLASSES
        self.within = np.zeros(self.groups**2)
        for c, n in class_uses.items():
            self.within[self.first_class + c] = -np.log(max(1, n))

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        """``counts`` are read several times, so they should be kept."""
        least = math.sqrt(counts.agg(F.sum("uses")).first()[0] or 0) / GROWTH
        often = counts.where(F.col("uses") >= least).count()
        top = counts.orderBy(F.desc("uses"), "word").limit(min(max(often, FREQUENT), MOST_WORDS))
        rows = sorted(top.collect(), key=lambda r: (-r["uses"], r["word"]))
        own = counts.sparkSession.createDataFrame([(r["word"],) for r in rows], "word string")
        rare = counts.join(F.broadcast(own), "word", "left_anti")
        rare_class = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(RARE_CLASSES)).cast("int")
        sizes = rare.groupBy(rare_class.alias("class")).agg(F.sum("uses").alias("n")).collect()
        return cls([r["word"] for r in rows], {r["class"]: r["n"] for r in sizes}, rare, [r["uses"] for r in rows])

    def token(self, word: str) -> int:
        """Of one word, as ``Encoder`` finds those of many."""
        return int(Encoder(self.frequent, self.first_class).codes(pa.array([word]))[0][0])

    def rare_arrays(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Hashes and uses of the rare words used more than once, sorted; None if they are too many for every task."""
        if self.rare is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        several = self.rare.where("uses > 1").select(F.xxhash64("word").alias("hash"), "uses")
        if several.count() * 16 > BROADCAST_BYTES:
            return None
        found = several.toArrow()
        hashes, uses = found["hash"].to_numpy(), found["uses"].to_numpy()
        order = np.argsort(hashes, kind="stable")
        return hashes[order], uses[order]


class Encoder:
    """Tokens of the words of texts and the log of their uses; each distinct word of many texts is looked up once."""

    def __init__(self, frequent: list[str], first_class: int, hashes: np.ndarray | None = None, uses: np.ndarray | None = None) -> None:
        self.frequent, self.first_class = pa.array(frequent, pa.string()), first_class
        self.hashes, self.uses = hashes, uses

    def codes(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The token of each word, and the log of the uses of each rare one (else 0)."""
        own = pc.index_in(words, value_set=self.frequent)
        tokens, logs = own.fill_null(0).to_numpy(zero_copy_only=False).astype(_TOKEN), np.zeros(len(words))
        rare = np.flatnonzero(own.is_null().to_numpy(zero_copy_only=False))
        raw = _raw(words.take(pa.array(rare)))
        tokens[rare] = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % RARE_CLASSES + self.first_class
        if self.hashes is not None and len(self.hashes) and raw:
            wanted = np.fromiter(map(xxhash.xxh64_intdigest, raw, repeat(42)), np.uint64, len(raw)).view(np.int64)
            # In their order, so that the search runs through memory once.
            order = np.argsort(wanted)
            wanted = wanted[order]
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            logs[rare[order]] = np.where(self.hashes[at] == wanted, np.log(self.uses[at]), 0.0)
        return tokens, logs

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[float]]:
        """Of each text its tokens, and the summed logs of the uses of its rare words."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        tokens, logs = self.codes(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        # White space at the ends of a text leaves empty strings there.
        words = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[at]
        ends = np.concatenate([[0], np.cumsum(words)])[split.offsets.to_numpy()][1:-1]
        at = at[words]
        return np.split(tokens[at], ends), [float(part.sum()) for part in np.split(logs[at], ends)]


def _raw(words: pa.Array) -> list[bytes]:
    """Strings as their UTF-8 bytes."""
    _, offsets, values = words.buffers()
    if not len(words) or values is None:
        return [b""] * len(words)
    data = values.to_pybytes()
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    return [data[low:high] for low, high in zip(ends[:-1], ends[1:], strict=True)]


def first_network(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """A fresh network whose biases give every token its share of the corpus."""
    groups = vocabulary.groups
    net = fresh_network(groups=groups)
    if vocabulary.uses:
        uses = np.full(groups**2, 0.5)
        uses[: len(vocabulary.uses)] += vocabulary.uses
        for c, n in vocabulary.class_uses.items():
            uses[vocabulary.first_class + c] += n
        table = uses.reshape(groups, groups)
        net["group_bias"] = np.log(table.sum(axis=1) / uses.sum()).astype(np.float32)
        net["member_bias"] = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    return net


def fresh_network(seed: int = SEED, groups: int = GROUPS) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    sizes = shapes(groups)
    net = {k: np.zeros(s, np.float32) for k, s in sizes.items()}
    net["vectors"] = rng.normal(0, 0.3, sizes["vectors"]).astype(np.float32)
    net["places"] += 1 / np.sqrt(len(_PLACES))
    for k in ("group", "member"):
        net[k] = rng.normal(0, 0.1, sizes[k]).astype(np.float32)
    return net


def _flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in shapes(GROUPS)])


def _shaped(flat: np.ndarray, groups: int) -> dict[str, np.ndarray]:
    sizes = [int(np.prod(s)) for s in shapes(groups).values()]
    return {k: part.reshape(s) for (k, s), part in zip(shapes(groups).items(), np.split(flat.astype(np.float32), np.cumsum(sizes)[:-1]), strict=True)}


def keep_freed_memory() -> None:
    """The arrays of a step are some MB and freed after it. Once a larger array has been freed, the C library keeps as much
    for the next step, where it would else give pages back and have them cleared again a thousand times a step."""
    np.empty(KEPT_BYTES, np.uint8)


def _laid_out(texts: list[np.ndarray], groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with edges between them, and the positions of the words."""
    edge = np.full(WINDOW, groups * groups, np.int32)
    parts, at, places = [edge], WINDOW, []
    for t in texts:
        parts += (t, edge)
        places.append(np.arange(at, at + len(t)))
        at += len(t) + WINDOW
    return np.concatenate(parts), np.concatenate(places) if places else np.zeros(0, int)


def _hidden(net: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """One row per position, with a last column of ones for the biases; and the ids around."""
    around = [row[at + k] for k in _PLACES]
    total = np.take(net["vectors"], around[0], axis=0)
    total *= net["places"][0]
    total += net["shift"]
    for ids, place in zip(around[1:], net["places"][1:], strict=True):
        near = np.take(net["vectors"], ids, axis=0)
        near *= place
        total += near
    h = np.ones((len(at), WIDTH + 1), total.dtype)
    np.tanh(total, out=h[:, :WIDTH])
    return h, around


def _by_group(row: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Positions in the order of their tokens: that order, group and member of each, and the stretch of each group."""
    targets = row[at].astype(_TOKEN)
    order = np.argsort(targets, kind="stable")
    groups, members = np.divmod(targets[order].astype(np.int64), size)
    ends = np.searchsorted(groups, np.arange(size + 1)).tolist()
    return order, groups, members, [(g, low, high) for g, (low, high) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if high > low]


def _levels(net: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the groups, and of the members of each group, with the biases as their last rows."""
    return np.vstack([net["group"], net["group_bias"]]), np.concatenate([net["member"], net["member_bias"][:, None]], axis=1)


def _scores(levels: tuple[np.ndarray, np.ndarray], h: np.ndarray, stretches: list[tuple[int, int, int]]) -> np.ndarray:
    """Of all groups and of the members of the own group: one column per row of ``h``, less its largest value."""
    group, member = levels
    x = np.empty((2, len(member), len(h)), h.dtype)
    turned = h.T
    np.matmul(group.T, turned, out=x[0])
    inside, weights = x[1], member.transpose(0, 2, 1)
    for g, low, high in stretches:
        np.matmul(weights[g], turned[:, low:high], out=inside[:, low:high])
    x -= x.max(axis=1, keepdims=True)
    return x


def log_probabilities(net: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the token at each position, given the tokens around it."""
    out = np.empty(len(at))
    levels = _levels(net)
    for low in range(0, len(at), AT_ONCE):
        here = at[low : low + AT_ONCE]
        order, groups, members, stretches = _by_group(row, here, len(net["group_bias"]))
        h, _ = _hidden(net, row, here[order])
        x = _scores(levels, h, stretches)
        each = np.arange(len(here))
        found = x[0, groups, each] + x[1, members, each]
        sums = np.exp(x, out=x).sum(axis=1)
        out[low + order] = found - np.log(sums).sum(axis=0)
    return out


def slopes(net: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean log-probability of the tokens at these positions."""
    n = len(at)
    order, groups, members, stretches = _by_group(row, at, len(net["group_bias"]))
    h, around = _hidden(net, row, at[order])
    levels = _levels(net)
    # The gradients of the scores: the chosen ones count 1 less the softmax, the others 0 less it, over the n positions.
    miss = _scores(levels, h, stretches)
    np.exp(miss, out=miss)
    miss /= miss.sum(axis=1, keepdims=True) * -n
    each = np.arange(n)
    miss[0, groups, each] += 1 / n
    miss[1, members, each] += 1 / n
    by_group = miss[0] @ h
    by_member = np.zeros(levels[1].shape, h.dtype)
    d_total = miss[0].T @ net["group"].T
    turned, inside, weights = h.T, miss[1].T, net["member"].transpose(0, 2, 1)
    for g, low, high in stretches:
        np.matmul(turned[:, low:high], inside[low:high], out=by_member[g])
        d_total[low:high] += inside[low:high] @ weights[g]
    flat = h[:, :WIDTH]
    d_total *= 1 - flat * flat
    out = {"shift": d_total.sum(axis=0), "places": np.empty_like(net["places"]), "vectors": np.zeros_like(net["vectors"])}
    out |= {"group": by_group[:, :WIDTH].T, "group_bias": by_group[:, WIDTH], "member": by_member[:, :WIDTH], "member_bias": by_member[:, WIDTH]}
    for j, ids in enumerate(around):
        # Sums over the positions that have the same token at this place.
        ids = ids.astype(_TOKEN)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        sums = np.add.reduceat(np.take(d_total, order, axis=0), first, axis=0)
        ids = ids[first]
        out["places"][j] = np.einsum("tw,tw->w", sums, np.take(net["vectors"], ids, axis=0))
        out["vectors"][ids] += sums * net["places"][j]
    return out


def climb(net: dict[str, np.ndarray], squares: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray) -> None:
    """One step of adaptive gradient ascent, in place."""
    for k, slope in slopes(net, row, at).items():
        squares[k] += slope * slope
        size = np.sqrt(squares[k])
        size += 1e-6
        np.divide(slope, size, out=size)
        size *= STEP
        net[k] += size


class Copy:
    """A network in training on one stream of texts; words are mixed within blocks."""

    def __init__(self, flat: np.ndarray, groups: int, seed: list[int]) -> None:
        self.groups = groups
        self.net = {k: v.copy() for k, v in _shaped(flat, groups).items()}
        self.squares = {k: np.full(v.shape, 1e-6, np.float32) for k, v in self.net.items()}
        self.rng = np.random.default_rng(seed)
        self.texts: list[np.ndarray] = []
        self.waiting = self.seen = 0

    def read(self, tokens: np.ndarray) -> None:
        self.texts.append(tokens)
        self.waiting += len(tokens)
        if self.waiting >= BLOCK_WORDS:
            self.learn()

    def learn(self) -> None:
        row, at = _laid_out(self.texts, self.groups)
        masked = self.rng.permutation(at)
        for k in range(0, len(masked), BATCH):
            climb(self.net, self.squares, row, masked[k : k + BATCH])
        self.seen += len(at)
        self.texts, self.waiting = [], 0

    def parts(self, replica: int) -> pa.RecordBatch:
        """The network times the words it saw, in chunks; no rows if it saw none."""
        self.learn()
        flat = _flat(self.net).astype(float) * self.seen
        parts = [flat[k : k + CHUNK].tobytes() for k in range(0, len(flat), CHUNK)] if self.seen else []
        n = len(parts)
        columns = [pa.array(range(n), pa.int32()), pa.array([replica] * n, pa.int64()), pa.array(parts, pa.binary()), pa.array([self.seen] * n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "replica", "total", "seen"])


def _sum_of_parts(parts: pa.Table) -> pa.Table:
    """One row of up to FAN_IN of a chunk, added in the order of the copies."""
    order = np.argsort(parts["replica"].to_numpy())
    totals = parts["total"].to_pylist()
    total = sum(np.frombuffer(totals[i]) for i in order)
    seen = sum(parts["seen"].to_pylist())
    replica = int(parts["replica"][0].as_py()) // FAN_IN
    return pa.table({"chunk": parts["chunk"][:1], "replica": pa.array([replica], pa.int64()), "total": pa.array([total.tobytes()], pa.binary()), "seen": pa.array([seen], pa.int64())})


_PARTS = "chunk int, replica bigint, total binary, seen bigint"


def train(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The averaged network after all texts have been read ``rounds`` times."""
    return train_encoded(keep(encode(docs, vocabulary, text), "tokens"), vocabulary, rounds)


def train_encoded(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """``train`` on the kept rows of ``encode``. Rows equal in every column meet in one copy."""
    spark = encoded.sparkSession
    groups = vocabulary.groups
    net = first_network(vocabulary)
    n_words = (encoded.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0) // np.dtype(_TOKEN).itemsize
    replicas = -(-n_words // REPLICA_WORDS)
    mixed = F.xxhash64(F.to_json("row"), "tokens").alias("mixed")
    dealt = encoded.select("tokens", mixed).withColumn("replica", F.pmod("mixed", F.lit(max(1, replicas))).cast("int"))
    dealt = dealt.repartitionById(max(1, replicas), "replica").sortWithinPartitions("replica", "mixed")
    for round_ in range(rounds if n_words else 0):
        begin = spark.sparkContext.broadcast(_flat(net))

        def run(batches: Iterator[pa.RecordBatch], begin=begin, round_=round_) -> Iterator[pa.RecordBatch]:
            keep_freed_memory()
            copy, current = None, None
            for batch in batches:
                for tokens, replica in zip(batch.column("tokens"), batch.column("replica").to_pylist(), strict=True):
                    if replica != current:
                        if copy is not None:
                            yield copy.parts(current)
                        copy, current = Copy(begin.value, groups, [SEED, round_, replica]), replica
                    copy.read(np.frombuffer(tokens.as_buffer(), _TOKEN))
            if copy is not None:
                yield copy.parts(current)

        parts = dealt.mapInArrow(run, _PARTS)
        left = replicas
        while True:
            parts = parts.groupBy("chunk", F.floor(F.col("replica") / FAN_IN).alias("at")).applyInArrow(_sum_of_parts, _PARTS)
            left = -(-left // FAN_IN)
            if left <= 1:
                break
        sums = sorted(parts.collect(), key=lambda r: r["chunk"])
        net = _shaped(np.concatenate([np.frombuffer(r["total"]) / r["seen"] for r in sums]), groups)
    return net


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of ``columns``, all if not given), ``tokens`` and ``rare_log``, the summed logs of the uses of rare words."""
    spark = docs.sparkSession
    content = F.col(f"`{text}`").cast("string")
    names = docs.columns if columns is None else columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    packed = docs.select(row, F.coalesce(content, F.lit("")).alias("text"), text_key(content).alias("text_key"))
    made = [StructField("tokens", BinaryType()), StructField("rare_log", DoubleType())]
    schema = StructType([packed.schema["row"], packed.schema["text_key"], *made])
    arrays = vocabulary.rare_arrays()
    shared = spark.sparkContext.broadcast((vocabulary.frequent, vocabulary.first_class, *(arrays or (None, None))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            texts = batch.column(1)
            for low, high in slices(texts, ENCODED_BYTES, "binary_length"):
                tokens, logs = encoder.encode(texts.slice(low, high - low))
                found = [pa.array([t.tobytes() for t in tokens], pa.binary()), pa.array(logs, pa.float64())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), *found], names=schema.names)

    encoded = packed.mapInArrow(run, schema)
    if arrays is not None:
        return encoded.drop("text_key")
    frequent = spark.createDataFrame([(w,) for w in vocabulary.frequent], "word string")
    logs = rare_uses(docs, vocabulary.rare, frequent, text)
    joined = encoded.drop("rare_log").join(logs, "text_key", "left")
    return joined.select("row", "tokens", F.coalesce("rare_log", F.lit(0.0)).alias("rare_log"))


def rare_uses(docs: DataFrame, rare: DataFrame, frequent: DataFrame, text: str = "text") -> DataFrame:
    """``text_key, rare_log``: per distinct text, the summed logs of the uses of its rare words."""
    content = F.col(f"`{text}`").cast("string")
    one = docs.select(content.alias("text"), text_key(content).alias("text_key")).groupBy("text_key").agg(F.first("text").alias("text"))
    words = one.select("text_key", F.explode(F.split("text", BLANKS)).alias("word")).where("word <> ''")
    # No rare word is used often, so none weighs in its task.
    found = words.join(F.broadcast(frequent), "word", "left_anti").join(rare.where("uses > 1"), "word")
    return found.groupBy("text_key").agg(F.sum(F.log("uses")).alias("rare_log"))


def text_key(content: Column) -> Column:
    """128 bits of a text."""
    return F.struct(F.xxhash64(content).alias("a"), F.xxhash64(F.lit(SEED), content).alias("b"))


def pseudo_likelihoods(docs: DataFrame, vocabulary: Vocabulary, net: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``log_likelihood`` (summed) and ``mean_log_likelihood`` (null without words).

    Null and empty texts have no words and the sum zero; texts are read whole; equal texts get equal scores; an empty frame
    gives an empty frame. Columns of these names are replaced.
    """
    return score_encoded(encode(docs, vocabulary, text), vocabulary, net)


_MADE = StructType([StructField("n_words", LongType()), StructField("log_likelihood", DoubleType()), StructField("mean_log_likelihood", DoubleType())])


def score_encoded(encoded: DataFrame, vocabulary: Vocabulary, net: dict[str, np.ndarray]) -> DataFrame:
    """``pseudo_likelihoods`` from the rows of ``encode``."""
    groups, within = vocabulary.groups, vocabulary.within
    shared = encoded.sparkSession.sparkContext.broadcast((within, _flat(net)))
    schema = StructType([encoded.schema["row"], *_MADE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        within, flat = shared.value
        own = _shaped(flat, groups)
        for batch in batches:
            tokens = [np.frombuffer(t.as_buffer(), _TOKEN) for t in batch.column("tokens")]
            counts = [len(t) for t in tokens]
            low = 0
            while low < len(tokens):
                high, size = low + 1, counts[low]
                while high < len(tokens) and size + counts[high] <= BLOCK_WORDS:
                    size += counts[high]
                    high += 1
                row, at = _laid_out(tokens[low:high], groups)
                each = log_probabilities(own, row, at) + within[row[at]]
                parts = np.split(each, np.cumsum(counts[low:high])[:-1])
                rare = batch.column("rare_log").slice(low, high - low).to_pylist()
                sums = [float(p.sum()) + more for p, more in zip(parts, rare, strict=True)]
                means = [s / n if n else None for s, n in zip(sums, counts[low:high], strict=True)]
                found = [pa.array(counts[low:high], pa.int64()), pa.array(sums, pa.float64()), pa.array(means, pa.float64())]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(low, high - low), *found], names=schema.names)
                low = high

    scored = encoded.select("row", "tokens", "rare_log").mapInArrow(run, schema)
    names = [c for c in encoded.schema["row"].dataType.names if c not in _MADE.names]
    return scored.select(*[F.col("row").getField(c).alias(c) for c in names], *_MADE.names)


def corpus_scores(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the scores of each document under a network trained on all of them; texts are tokenised once."""
    rows = docs.select("doc_id", "text")
    vocabulary = Vocabulary.of(keep(word_counts(rows), "words"))
    encoded = keep(encode(rows, vocabulary, columns=["doc_id"]), "tokens")
    return score_encoded(encoded, vocabulary, train_encoded(encoded, vocabulary))
