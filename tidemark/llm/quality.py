"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Every rule rejects documents whose measure, in thousandths, reaches a cutoff. Cutoffs are not guessed: for each
stratum (language) and rule, the labelled documents of good quality form a holdout, and the lowest cutoff is taken for
which an exact binomial test shows that the rule rejects at most its share of good documents. With ``n`` good
documents of which ``k`` reach a cutoff, a false rejection rate above ``alpha`` is refuted at level ``delta`` if
P(Binomial(n, alpha) <= k) <= delta (the Clopper-Pearson upper bound of the rate is then below alpha). Candidate
cutoffs are nested, so they are tested from the mildest on and need no correction among themselves; over rules and
strata the level is divided by their number (Bonferroni). Hence, with confidence ``delta``, no stratum loses more than
``alpha`` of its good documents. A rule must also pay: a cutoff stands only if, among labelled documents of bad
quality, it rejects a larger share. A stratum with too few labels gets no cutoff and loses nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, all_of, keep, small

#: Largest share of a stratum's good documents that all rules together may reject, and the chance that one does.
ALPHA = 0.02
DELTA = 0.05

MIN_WORDS = 10
WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: Measures in thousandths; a document is suspect the higher they are.
RULES = ("symbols", "dup_lines", "repeats", "short_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def with_repeats(df: DataFrame, hashes: str = "hashes") -> DataFrame:
    """``df`` with ``n_repeat_words``: words inside windows that occur at least twice.

    Windows compare by a 64-bit hash of their word hashes. Texts that repeat no window, most of them, skip the sort.
    Each step is a projection of its own, so that no step is computed anew for every element of the next.
    """
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
    windows = F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(F.col(hashes), i + k) for k in range(1, WINDOW)]))
    df = df.withColumn("windows", windows).drop(hashes)
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("placed", F.when(repeats, placed).otherwise(F.slice(placed, 1, 0))).drop("windows")

    def equals(i: Column, w: Column) -> Column:
        return F.coalesce(F.get(F.col("placed"), i)["h"] == w["h"], F.lit(False))

    twice = F.filter("placed", lambda w, i: equals(i - 1, w) | equals(i + 1, w))
    df = df.withColumn("twice", F.array_sort(F.transform(twice, lambda w: w["i"]))).drop("placed")
    covered = F.aggregate(
        "twice",
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("words")),
        lambda a, s: F.struct((s + WINDOW).alias("to"), (a["words"] + s + WINDOW - F.greatest(a["to"], s)).alias("words")),
        lambda a: a["words"],
    )
    return df.withColumn("n_repeat_words", covered.cast("bigint")).drop("twice")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` packed as ``row`` with the counts of its text; null text has no words."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    split = docs.select(all_of(docs).alias("row"), content.alias("content")).withColumn("words", words_of(F.col("content")))
    lines = F.filter(F.split("content", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.withColumn("lines", lines).select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("content") - F.length(F.translate("content", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    return with_repeats(counted)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _thousandths(part: Column, whole: Column) -> Column:
    return F.coalesce(F.floor(part * 1000 / F.nullif(whole, F.lit(0))), F.lit(0)).cast("bigint")


def rule_values() -> Column:
    """The measures of RULES, in their order; ratios of integers, so they are the same everywhere."""
    return F.array(
        _thousandths(F.col("n_symbols"), F.col("word_chars")),
        _thousandths(F.col("n_dup_lines"), F.col("n_lines")),
        _thousandths(F.col("n_repeat_words"), F.col("n_words")),
        _thousandths(F.col("n_words"), F.col("word_chars")),
    )


def allowed(n: Column, alpha: float, level: Column) -> Column:
    """The largest k with P(Binomial(n, alpha) <= k) <= level, or -1; terms are summed as logarithms."""
    odds = math.log(alpha) - math.log1p(-alpha)
    first = n * F.lit(math.log1p(-alpha))
    state = F.struct(first.alias("term"), first.alias("sum"), F.when(first <= F.log(level), 0).otherwise(-1).cast("bigint").alias("k"))

    def more(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        total = F.greatest(a["sum"], term) + F.log1p(F.exp(-F.abs(a["sum"] - term)))
        return F.struct(term.alias("term"), total.alias("sum"), F.when(total <= F.log(level), i).otherwise(a["k"]).alias("k"))

    # At k above the mean the probability exceeds any level below one half.
    steps = F.sequence(F.lit(1).cast("bigint"), F.greatest(F.lit(1), F.ceil(n * alpha)).cast("bigint"))
    return F.aggregate(steps, state, more, lambda a: a["k"])


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum, cutoffs``: one cutoff per rule (null: none), from rows ``stratum, values, good``.

    Only counts by (stratum, rule, measure) leave the scan, however many labels there are.
    """
    strata = labelled.select("stratum").distinct().agg(F.count("*").alias("strata"))
    each = labelled.select("stratum", "good", F.posexplode("values").alias("rule", "value"))
    hist = each.groupBy("stratum", "rule", "value").agg(F.sum(F.col("good").cast("bigint")).alias("good"), F.count("*").alias("n"))
    # A measure has at most a few thousand values, so the rows of one (stratum, rule) are few.
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("value"))
    reached = hist.select("stratum", "rule", "value", F.sum("good").over(down).alias("k"), F.sum(F.col("n") - F.col("good")).over(down).alias("bad"))
    sums = hist.groupBy("stratum", "rule").agg(F.sum("good").alias("goods"), F.sum(F.col("n") - F.col("good")).alias("bads"))
    level = F.lit(delta) / (F.col("strata") * len(RULES))
    most = sums.crossJoin(F.broadcast(strata)).select("stratum", "rule", "goods", "bads", allowed(F.col("goods"), alpha / len(RULES), level).alias("most"))
    passes = (F.col("value") > 0) & (F.col("k") <= F.col("most")) & (F.col("bad") * F.col("goods") > F.col("k") * F.col("bads"))
    tested = reached.join(most, ["stratum", "rule"])
    chosen = tested.groupBy("stratum", "rule").agg(F.min(F.when(passes, F.col("value"))).alias("cutoff"))
    return chosen.groupBy("stratum").agg(F.transform(F.array_sort(F.collect_list(F.struct("rule", "cutoff"))), lambda r: r["cutoff"]).alias("cutoffs"))


def judged(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``row`` (all columns of ``docs``) with the counts, ``base_failed`` and ``kept``.

    Texts are measured once and written with their rows to the shared folder; cutoffs come from that table's narrow
    columns and are joined to it. ``labels`` has ``doc_id, quality``; ids or qualities that are null count for nothing, and of
    several labels of an id the worst holds. Null and empty texts have no words and fail; a null language is a stratum of
    its own; documents without an id are judged like others; repeated rows are judged alike; without labels, or
    documents, there are no cutoffs and only the base rules reject. Documents that fail the base rules do not enter the
    holdout: no cutoff can lose them again.
    """
    measured = measures(docs).withColumn("values", rule_values())
    stratum = F.coalesce(F.col("row")["lang"].cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    stored = keep(measured.select("*", stratum.alias("stratum"), base_failed().alias("base_failed"), F.col("row")["doc_id"].alias("doc_id")), "measured")
    quality = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    holdout = stored.where("not base_failed").select("doc_id", "stratum", "values").join(quality, "doc_id")
    chosen = keep(cutoffs(holdout.select("stratum", "values", (F.col("quality") == 1).alias("good")), alpha, delta), "cutoffs")
    reached = F.exists(F.arrays_zip("values", F.col("cutoffs")), lambda x: F.coalesce(x["values"] >= x["cutoffs"], F.lit(False)))
    return stored.join(small(chosen), "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~F.coalesce(reached, F.lit(False)))


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "text", "lang"), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents kept; columns are those of ``docs``."""
    return judged(docs, labels).where("kept").select("row.*")
