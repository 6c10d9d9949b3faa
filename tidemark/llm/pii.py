"""Personal data with exact source offsets, also where it is disguised.

Plain identifiers are found in the text as it stands. Then a chain of transducers rewrites a disguised text: characters
that look like or stand for ASCII ones, spelled digits, and the words at, dot and plus in their usual disguises. Each
transducer yields its output with the source range of every output character, so chains compose and identifiers found
in the rewritten text map back to ranges of the source. Ranges that overlap a plain find of the same kind add nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import add_columns

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its first digit only: a match could not begin later without having begun there.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")


def emails(text: str) -> Iterable[tuple[int, int]]:
    """From each at sign outwards, so a long run of letters without one costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterable[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in m.groups())):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> Iterable[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterable[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (emails, addresses, cards, phones), strict=True))

# Letters of other scripts that are drawn like ASCII ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "α": "a", "ο": "o", "ν": "v", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ⅼ": "l",
    "․": ".", "。": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
UNSEEN = "­​‌‍⁠﻿"
DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_GAP = r"(?<![ \t])[ \t]*+"  # a run of blanks is entered at its begin only
_AT = re.compile(rf"{_GAP}{_OPEN}[ \t]*(?:at|@)[ \t]*{_CLOSE}[ \t]*|(?<=[A-Za-z0-9])[ \t]+@[ \t]+(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])_at_(?=[A-Za-z0-9])", re.I | re.A)
_DOT = re.compile(rf"{_GAP}{_OPEN}[ \t]*(?:dot|\.)[ \t]*{_CLOSE}[ \t]*|(?<=[A-Za-z0-9])_dot_(?=[A-Za-z0-9])", re.I | re.A)
_WORDY = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{1,64}(?:(?: dot |\.)[A-Za-z0-9_%+-]{1,64}){0,4}( at )[A-Za-z0-9-]{1,63}(?:(?: dot |\.)(?!dot\b)[A-Za-z0-9-]{1,63}){0,4} dot (?!dot\b)[A-Za-z]{2,24}(?![A-Za-z0-9])", re.I | re.A)
_AT_OR_DOT_WORD = re.compile(r" at | dot ", re.I | re.A)
_SPELLED = re.compile(r"(?<![A-Za-z0-9])(?:plus[ -]+)?(?:(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|[0-9]+)[ -]+){4,}(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|[0-9]+)(?![A-Za-z0-9])", re.I | re.A)
_SPELLED_PART = re.compile(r"plus|[a-z]+|[0-9]+", re.I | re.A)


class Mapped:
    """A rewritten text with the source range of each of its characters."""

    def __init__(self, text: str, starts: list[int] | range, stops: list[int] | range) -> None:
        self.text, self.starts, self.stops = text, starts, stops

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def replaced(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Ranges replaced by text; each new character stands for its whole range. Edits are in order and apart."""
        if not edits:
            return self
        text, starts, stops, at = [], [], [], 0
        for low, high, new in edits:
            text += (self.text[at:low], new)
            starts += (*self.starts[at:low], *[self.starts[low]] * len(new))
            stops += (*self.stops[at:low], *[self.stops[high - 1]] * len(new))
            at = high
        return Mapped("".join([*text, self.text[at:]]), [*starts, *self.starts[at:]], [*stops, *self.stops[at:]])

    def source(self, low: int, high: int) -> tuple[int, int]:
        return self.starts[low], self.stops[high - 1]


@lru_cache(maxsize=100_000)
def _plain_character(c: str) -> str:
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c in UNSEEN:
        return ""
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() else c


def fold_characters(m: Mapped) -> Mapped:
    if m.text.isascii():
        return m
    return m.replaced([(x.start(), x.end(), new) for x in _NOT_ASCII.finditer(m.text) if (new := _plain_character(x[0])) != x[0]])


def fold_digit_words(m: Mapped) -> Mapped:
    edits = []
    for run in _SPELLED.finditer(m.text):
        parts = [(p.start(), p.end(), p[0].lower()) for p in _SPELLED_PART.finditer(m.text, run.start(), run.end())]
        if any(word in DIGIT_WORDS for _, _, word in parts):
            # The gap after a part goes with it, so that digits stand together.
            ends = [start for start, _, _ in parts[1:]] + [parts[-1][1]]
            edits += [(a, to, "+" if w == "plus" else DIGIT_WORDS.get(w, w)) for (a, _, w), to in zip(parts, ends, strict=True)]
    return m.replaced(edits)


def fold_at_and_dot(m: Mapped) -> Mapped:
    edits = [(x.start(), x.end(), "@") for x in _AT.finditer(m.text)] + [(x.start(), x.end(), ".") for x in _DOT.finditer(m.text)]
    m = m.replaced(sorted(edits))
    lowered = m.text.lower()
    if " at " not in lowered or " dot " not in lowered:  # _WORDY needs both
        return m
    edits = []
    for x in _WORDY.finditer(m.text):
        edits += [(y.start(), y.end(), "@" if y[0].lower() == " at " else ".") for y in _AT_OR_DOT_WORD.finditer(m.text, *x.span())]
    return m.replaced(edits)


TRANSDUCERS = (fold_characters, fold_digit_words, fold_at_and_dot)


def find_all(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain finds, and disguised ones that overlap no plain find of their kind; each by kind, then start."""
    plain = [(kind, *span) for kind in KINDS for span in FINDERS[kind](text)]
    m = Mapped.of(text)
    for transducer in TRANSDUCERS:
        m = transducer(m)
    if m.text == text:
        return plain, []
    hidden = []
    for kind in KINDS:
        taken = [(a, b) for k, a, b in plain if k == kind]
        at = 0
        for low, high in FINDERS[kind](m.text):
            a, b = m.source(low, high)
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at == len(taken) or taken[at][0] >= b:
                hidden.append((kind, a, b))
    return plain, hidden


SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``plain_spans`` and ``hidden_spans``: arrays of (kind, start, end), code points, end exclusive.

    Null and empty texts have no spans; texts of any length are read whole, in time proportional to their length; rows
    are independent, so repeated rows and nulls elsewhere change nothing. Columns of these names are replaced.
    """

    def start():
        def compute(texts: list[str]) -> list[list]:
            found = [find_all(t) for t in texts]
            return [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f[side]] for f in found] for side in (0, 1)]

        return compute

    made = StructType([StructField("plain_spans", ArrayType(SPAN)), StructField("hidden_spans", ArrayType(SPAN))])
    return add_columns(docs, text, made, start)


def redacted(text: str) -> str:
    """The text with each find replaced by its kind in brackets; overlapping finds become one, named by the first."""
    plain, hidden = find_all(text)
    spans = sorted((a, -b, kind) for kind, a, b in plain + hidden)
    out, at, merged = [], 0, []
    for a, b, kind in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], -b)
        else:
            merged.append([a, -b, kind])
    for a, b, kind in merged:
        out += (text[at:a], f"[{kind.upper()}]")
        at = b
    return "".join([*out, text[at:]])


def redact_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every find in ``text`` replaced by its kind in brackets; null texts stay null; all else is kept."""

    def start():
        return lambda texts: [[redacted(t) for t in texts]]

    source = "text_before_redaction"
    while source in docs.columns:
        source += "_"
    made = add_columns(docs.withColumnRenamed(text, source), source, StructType([StructField(text, StringType())]), start)
    clean = F.when(F.col(f"`{source}`").isNotNull(), F.col(f"`{text}`"))
    return made.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def personal_data_digests(docs: DataFrame) -> DataFrame:
    """Per document: counts of the plain finds by kind, a digest of their spans, and all spans as text."""
    found = find_personal_data(docs.select("doc_id", "text"))

    def counted(kind: str):
        return F.size(F.filter("plain_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def by_start(kind: str):
        spans = F.filter(F.concat("plain_spans", "hidden_spans"), lambda s: s["kind"] == kind)
        return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    return found.select(
        "doc_id",
        *[counted(k) for k in KINDS],
        F.sha2(written(F.col("plain_spans")), 256).alias("base_sha256"),
        written(F.concat(*[by_start(k) for k in KINDS])).alias("spans"),
    )
