"""Benchmark decontamination as a prefix-filtered set join, in DataFrame expressions only.

Every window of a benchmark item is a set of word shingles with their offsets. A text that holds the window holds all
of them, so to find it one shingle is enough: the prefix of the window when its shingles are ordered by rarity in the
corpus, which is one long because a window must be contained whole. The join goes through three steps.

1. Postings: all occurrences in all texts of shingles that occur in windows, with their positions and the text's length.
2. Candidates: counts of the postings give the order; windows meet the postings of their rarest shingle only, where the
   alignment stays within the text (length and positional bounds). A window with a shingle that no text holds is out.
3. Verification: each text compares its words with its candidate windows, in the task that reads it.

Texts are told apart by a digest, so copies share postings and ids may be null or repeated. Text itself is shuffled
only if the candidates turn out too large to be sent to the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import all_of, keep, small

WINDOW = 13
SHINGLE = 3
#: A document is contaminated if one in so many of its words is hit.
SHARE = 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def _shingles(hashes: str, width: int) -> Column:
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (width - 1), F.lit(0)))
    return F.transform(
        starts,
        lambda h, i: F.struct(
            i.alias("at"), F.xxhash64(F.lit(width), h, *[F.get(F.col(hashes), i + k) for k in range(1, width)]).alias("shingle")
        ),
    )


def _hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``window_id, item, length, words, hashes, width``: all windows of all items; a short item is one window."""
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    length = F.least(F.size("all"), F.lit(window))
    each = split.select("item", "all", length.alias("length"), F.explode(F.sequence(F.lit(0), F.size("all") - length)).alias("start"))
    cut = each.select("item", "length", F.slice(F.col("all"), F.col("start") + 1, F.col("length")).alias("words")).distinct()
    return cut.withColumn("hashes", _hashes("words")).withColumn("width", F.least("length", F.lit(SHINGLE)))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """``item, length, window, at, shingle``: every shingle of every window with its offset."""
    every = None
    for width in range(1, SHINGLE + 1):
        part = windows.where(F.col("width") == width).select(
            "item", "length", F.array_join("words", " ").alias("window"), F.inline(_shingles("hashes", width))
        )
        every = part if every is None else every.unionByName(part)
    return every


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``row`` (all columns of ``docs``) with ``n_words, n_hit, items, contaminated``.

    A word is hit if it lies inside an occurrence of any window of any item; ``items`` are the ids, as sorted strings, of
    items with occurring windows. Null and empty texts have no words, no hits and are clean; null or empty items have
    no windows; items that repeat count once by id, a null id counts as an empty string; without items everything is
    clean; repeated documents get equal results; an empty frame gives an empty frame.
    """
    content = docs.select(F.col(f"`{text}`").cast("string").alias("content"))
    shingles = keep(_window_shingles(windows_of(items, window)), "windows")
    widths = sorted(r[0] for r in shingles.select(F.least("length", F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]
    wanted = keep(shingles.select("shingle").distinct(), "shingles")

    hashed = content.select(F.md5("content").alias("digest"), words_of(F.col("content")).alias("words")).select("digest", _hashes("words").alias("hashes"))
    tokens = F.concat(*[_shingles("hashes", w) for w in widths])
    every = hashed.select("digest", F.size("hashes").alias("n"), F.inline(tokens))
    postings = keep(every.join(small(wanted), "shingle"), "postings")

    counts = postings.groupBy("shingle").agg(F.count("*").alias("uses"))
    ordered = shingles.join(counts, "shingle", "left").groupBy("item", "length", "window")
    # A shingle that no text holds comes first and finds nothing.
    rarest = keep(ordered.agg(F.min_by(F.struct("shingle", "at"), F.struct(F.coalesce("uses", F.lit(0)), "at")).alias("prefix")), "prefixes")
    prefixes = rarest.select("item", "length", "window", "prefix.shingle", F.col("prefix.at").alias("offset"))
    begin = F.col("at") - F.col("offset")
    met = postings.distinct().join(small(keep(prefixes, "prefixes")), "shingle").where((begin >= 0) & (begin + F.col("length") <= F.col("n")))
    found = F.collect_set(F.struct(begin.alias("begin"), "length", "item", "window"))
    candidates = small(keep(met.groupBy("digest").agg(found.alias("candidates")), "candidates"))

    rows = docs.select(all_of(docs).alias("row"), F.md5(F.col(f"`{text}`").cast("string")).alias("digest"), words_of(F.col(f"`{text}`")).alias("words"))
    checked = rows.join(candidates, "digest", "left").select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.filter("candidates", lambda c: F.array_join(F.slice(F.col("words"), c["begin"] + 1, c["length"]), " ") == c["window"]).alias("hits"),
    )
    ranges = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h["begin"], h["length"]))))
    placed = checked.select("row", "n_words", "hits", ranges.alias("ranges"))
    covered = F.aggregate(
        "ranges",
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("words")),
        lambda a, r: F.struct(
            F.greatest(a["to"], r["begin"] + r["length"]).alias("to"),
            (a["words"] + F.greatest(r["begin"] + r["length"] - F.greatest(a["to"], r["begin"]), F.lit(0))).alias("words"),
        ),
        lambda a: a["words"].cast("bigint"),
    )
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item"])))
    out = placed.select(
        "row", "n_words", F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce(names, F.array().cast("array<string>")).alias("items")
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def contamination_digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(docs.select("doc_id", "text"), items)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated; columns are those of ``docs``."""
    return contamination(docs, items).where(~F.col("contaminated")).select("row.*")
