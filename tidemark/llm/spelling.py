"""Spelling variants: the vocabulary's acceptor composed with one edit and with itself.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts with A-Z in lower case, of at least ``LEAST_LENGTH`` code
points and ``LEAST_USES`` uses. Two are near if one inserted, deleted or replaced code point makes one of the other.

The composition of a vocabulary V with the one-edit transducer E and V again accepts the pairs of near words. Its runs begin
with equal letters, edit once, and go on with equal letters, so it is cut by the state that they begin in: pairs of lengths
(m, m) and (m, m + 1) whose edit, counted as the length of the common prefix, lies in a stretch [low, high) share their
first ``low`` letters and their last ones behind the stretch. All words with one (m, low, high, shared letters) form one
partition. A partition of more than ``PART_WORDS`` words, or of a stretch beyond ``PART_LETTERS``, is cut in two at the middle of its
stretch, and again, until it is small or its stretch is one letter, where the alphabet bounds it. Every pair stays in
exactly one partition, and a partition of one word ends. One task then builds the minimal acceptor of the letters left
open in its partition and enumerates the composition: from a state that both sides reach unedited, each pair of labels (or a
label and none), then the words that both states accept; where minimisation made them one state, all of its words.

Pairs do not leave the task: it gives per word how many near ones it met and the most used of them, and these are combined.
``form`` is the near word used most (ties: first in code-point order) if used at least twice as often, else null; ``root``
follows forms to the last one by doubling steps.

Null texts have no words. In the rule that deletes letters a null id is written as an empty one. Repeated rows count again.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LEAST_LENGTH = 5
LEAST_USES = 3
#: One run in so many, by its hash with the document's id, loses a letter.
STRUCK = 97
#: Distinct words a task counts before it hands them on.
COUNTED_WORDS = 200_000
PART_WORDS = 10_000
PART_LETTERS = 200


def struck(word: str, prefix: int) -> str:
    """``word``, without one letter if the hash of document and word says so."""
    h = zlib.crc32(word.encode(), prefix)
    if h % STRUCK:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_uses(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``word, n`` of all words of the corpus; tasks count before the shuffle, in bounded tables."""
    packed = docs.select(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def handed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            ids, texts = batch.column("doc"), batch.column("text")
            for low, high in slices(texts):
                for doc, value in zip(ids.slice(low, high - low).to_pylist(), texts.slice(low, high - low).to_pylist()):
                    # Equal runs of a document have equal hashes, so each is looked at once.
                    prefix = zlib.crc32(f"{doc}:".encode())
                    for run_, n in Counter(RUN.findall(value)).items():
                        word = struck(run_ if run_.islower() else run_.translate(LOWER), prefix)
                        if len(word) >= LEAST_LENGTH:
                            counts[word] += n
                    if len(counts) > COUNTED_WORDS:
                        yield handed(counts)
                        counts.clear()
        yield handed(counts)

    return packed.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The minimal acceptor of sorted distinct words, built word by word; states are numbers, equal ones are one."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], bool]] = [({}, False)]
        letters = ""

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                arcs, final = path.pop()
                state = (final, *arcs.items())
                number = known.setdefault(state, len(self.arcs))
                if number == len(self.arcs):
                    self.arcs.append(arcs)
                    self.final.append(final)
                path[-1][0][letters[len(path) - 1]] = number

        for word in words:
            shared = 0
            for a, b in zip(letters, word):
                if a != b:
                    break
                shared += 1
            settle(shared)
            path.extend(({}, False) for _ in range(len(word) - shared))
            path[-1] = (path[-1][0], True)
            letters = word
        settle(0)
        self.start = len(self.arcs)
        self.arcs.append(path[0][0])
        self.final.append(path[0][1])
        self._suffixes: dict[int, list[str]] = {}
        self._shared: dict[tuple[int, int], list[str]] = {}

    def suffixes(self, state: int) -> list[str]:
        """All words accepted from a state."""
        if state not in self._suffixes:
            found = [""] if self.final[state] else []
            found.extend(letter + rest for letter, to in self.arcs[state].items() for rest in self.suffixes(to))
            self._suffixes[state] = found
        return self._suffixes[state]

    def shared(self, a: int, b: int) -> list[str]:
        """All words accepted from both states."""
        if a == b:
            return self.suffixes(a)
        if a > b:
            a, b = b, a
        if (a, b) not in self._shared:
            found = [""] if self.final[a] and self.final[b] else []
            left, right = self.arcs[a], self.arcs[b]
            for letter in left.keys() & right.keys():
                found.extend(letter + rest for rest in self.shared(left[letter], right[letter]))
            self._shared[a, b] = found
        return self._shared[a, b]

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Unordered pairs of words from a state that differ by one edit of their first letters, the shorter first."""
        found = []
        arcs = list(self.arcs[state].items())
        for at, (letter, to) in enumerate(arcs):
            for other, also in arcs[at + 1 :]:
                found.extend((letter + rest, other + rest) for rest in self.shared(to, also))
            found.extend((rest, letter + rest) for rest in self.shared(state, to) if rest[:1] != letter)
        return found

    def near(self) -> Iterator[tuple[str, str]]:
        """Every pair of near words once: by the common prefix of the two, whose end both reach unedited."""
        memo: dict[int, list[tuple[str, str]]] = {}
        waiting = [("", self.start)]
        while waiting:
            prefix, state = waiting.pop()
            if state not in memo:
                memo[state] = self.edits(state)
            for a, b in memo[state]:
                yield prefix + a, prefix + b
            waiting.extend((prefix + letter, to) for letter, to in self.arcs[state].items())


def partitions(words: DataFrame) -> DataFrame:
    """``part, m, low, high, word, n``: words by the partitions of the composition that they may begin in."""
    size = F.length("word")
    least = F.explode(F.array(size, size - 1))
    # ``high`` is beyond the last letter: a letter may be added there.
    open_ = words.select("word", "n", least.alias("m"), F.lit(0).alias("low")).withColumn("high", F.col("m") + 1)
    done: DataFrame | None = None
    while True:
        open_ = keep(open_.withColumn("part", _part()), "open")
        sizes = open_.groupBy("part").agg(F.count("*").alias("words")).where("words > 1")
        stretch = F.col("high") - F.col("low")
        large = (stretch > 1) & ((F.col("words") > PART_WORDS) | (stretch > PART_LETTERS))
        sized = keep(open_.join(sizes, "part").withColumn("large", large).drop("words"), "sized")
        small = sized.where("not large").drop("large")
        done = small if done is None else done.unionByName(small)
        cut = sized.where("large")
        if cut.isEmpty():
            return done
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        sides = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
        open_ = cut.select("word", "n", "m", F.explode(sides).alias("side")).select("word", "n", "m", "side.*")


def _part():
    """What the words of a partition share: lengths, stretch, and the letters before and behind it.

    An edit before ``high`` leaves the letters behind it: m - high of them, since the shorter word has m.
    """
    behind = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    ends = F.concat(F.expr("substring(word, 1, low)"), F.lit("\n"), F.substring("word", F.length("word") - behind + 1, F.length("word")))
    return F.md5(F.concat_ws("\n", "m", "low", "high", ends))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n``: each word that has near ones, how many, and the most used."""
    kinds = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def compose(table: pa.Table) -> pa.Table:
        m, low, high = (table.column(c)[0].as_py() for c in ("m", "low", "high"))
        behind = max(m - high, 0)
        uses = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
        one = next(iter(uses))
        prefix, suffix = one[:low], one[len(one) - behind :]
        count: Counter = Counter()
        best: dict[str, tuple[int, str]] = {}
        for a, b in Acceptor(sorted(word[low : len(word) - behind] for word in uses)).near():
            a, b = prefix + a + suffix, prefix + b + suffix
            # Pairs of two longer words, and those with a common prefix of ``high`` letters, are of other partitions.
            if len(a) != m or a[:high] == b[:high]:
                continue
            for word, other in ((a, b), (b, a)):
                count[word] += 1
                rank = (-uses[other], other)
                if word not in best or rank < best[word]:
                    best[word] = rank
        return pa.Table.from_arrays(
            [pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64()), pa.array([best[w][1] for w in count], pa.string()), pa.array([-best[w][0] for w in count], pa.int64())],
            schema=kinds,
        )

    met = partitions(words).groupBy("part").applyInArrow(compose, "word string, n_near bigint, near string, near_n bigint")
    first = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("word")))
    found = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return found.select("word", "n_near", F.col("first.word").alias("near"), (-F.col("first.rank")).alias("near_n"))


def spelling_variants(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary."""
    words = keep(word_uses(docs, text, id).where(F.col("n") >= LEAST_USES), "vocabulary")
    used = F.col("near_n") >= 2 * F.col("n")
    linked = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(used, F.col("near")).alias("form"), F.when(used, F.col("near_n")).alias("form_n")
    )
    linked = keep(linked, "forms")
    steps = linked.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        # A form is used twice as often as its word, so chains end, and each round doubles the step.
        steps = keep(steps, "steps")
        beyond = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(beyond, "root")
        if longer.isEmpty():
            break
        steps = steps.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return linked.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
