"""Secrets by regular expressions behind a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: an alternation needs one of its branches, a
sequence all of its literal stretches, a stretch all of its trigrams. The texts of a slice are indexed by the trigrams
that occur in queries (lower-cased, so one index serves patterns in either case); postings are united and intersected
as the query says, and only the candidates are searched with the pattern. A rule whose pattern has no mandatory
trigram, such as a run of hex digits, is searched in every text. The index of a slice lives in the task that holds the
slice: nothing is shuffled, and memory follows the slice.
"""

from __future__ import annotations

import re
import re._constants as node
import re._parser as parser
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import add_columns

#: A query is None (no condition), a trigram, or ("and" | "or", parts).
Query = None | str | tuple[str, tuple]


def _joined(how: str, parts: Iterable[Query]) -> Query:
    parts = list(parts)
    if how == "or" and (not parts or any(p is None for p in parts)):
        return None
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else (how, tuple(parts))


def _trigrams(literal: str) -> Query:
    return _joined("and", (literal[i : i + 3] for i in range(len(literal) - 2)))


def _sequence(items: Iterable) -> Query:
    """All mandatory parts of a sequence; a character with variants that fold to one lower-case letter is a literal."""
    parts: list[Query] = []
    run = ""
    for op, value in items:
        letter = None
        if op is node.LITERAL:
            letter = chr(value).lower()
        elif op is node.IN and all(o is node.LITERAL for o, _ in value) and len({chr(v).lower() for _, v in value}) == 1:
            letter = chr(value[0][1]).lower()
        if letter is not None and letter.isascii():
            run += letter
            continue
        parts.append(_trigrams(run))
        run = ""
        if op is node.SUBPATTERN:
            parts.append(_sequence(value[3]))
        elif op is node.BRANCH:
            parts.append(_joined("or", (_sequence(branch) for branch in value[1])))
        elif op in (node.MAX_REPEAT, node.MIN_REPEAT, node.POSSESSIVE_REPEAT) and value[0] > 0:
            parts.append(_sequence(value[2]))
    parts.append(_trigrams(run))
    return _joined("and", parts)


def trigram_query(pattern: str) -> Query:
    """A condition on the lower-cased text's trigrams that every match of the pattern implies."""
    return _sequence(parser.parse(pattern))


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and what a match must meet besides (a match that fails is dropped)."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = lambda m: True


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The rules of the contract, then those the method adds.
BASE = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: m.end(2) - m.start(2) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}(?:-----END [A-Z ]{0,20}PRIVATE KEY-----)?"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host_token", r"(?:ghp_|gho_|ghs_|glpat-)[A-Za-z0-9_-]{20,}"),
    Rule("chat_token", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{6,128}@"),
)
RULES = BASE + ADDED


class Scanner:
    """Rules with their compiled patterns and queries, and the trigrams those need."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = [(r.kind, re.compile(r.pattern), r.accept, trigram_query(r.pattern)) for r in rules]
        self.wanted = sorted({t for *_, q in self.rules for t in self._leaves(q)})
        codes = [self._code(t.encode()) for t in self.wanted]
        self.place = np.full(1 << 24, -1, np.int16)
        self.place[codes] = np.arange(len(codes))

    @staticmethod
    def _code(three: bytes) -> int:
        return three[0] << 16 | three[1] << 8 | three[2]

    def _leaves(self, query: Query) -> Iterable[str]:
        if isinstance(query, str):
            yield query
        elif query:
            for part in query[1]:
                yield from self._leaves(part)

    def index(self, texts: list[str]) -> dict[str, set[int]]:
        """Postings: the numbers of the texts that hold each wanted trigram."""
        raw = [t.encode() for t in texts]
        joined = np.frombuffer(b"\n\n".join(raw), np.uint8)
        postings: dict[str, set[int]] = {t: set() for t in self.wanted}
        if joined.size < 3:
            return postings
        upper = (joined >= 65) & (joined <= 90)
        folded = (joined + (upper * 32).astype(np.uint8)).astype(np.int32)
        found = self.place[folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]]
        at = np.flatnonzero(found >= 0)
        ends = np.cumsum([len(r) + 2 for r in raw])
        owner = np.searchsorted(ends, at, side="right")
        for pair in np.unique(owner * len(self.wanted) + found[at]).tolist():
            postings[self.wanted[pair % len(self.wanted)]].add(pair // len(self.wanted))
        return postings

    def candidates(self, query: Query, postings: dict[str, set[int]], every: range) -> Iterable[int]:
        if query is None:
            return every
        if isinstance(query, str):
            return postings[query]
        parts = [set(self.candidates(p, postings, every)) for p in query[1]]
        return set.intersection(*parts) if query[0] == "and" else set.union(*parts)

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Spans of each text, by start, then rule."""
        postings = self.index(texts)
        found: list[list[tuple[int, int, int, str]]] = [[] for _ in texts]
        for order, (kind, pattern, accept, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, range(len(texts))):
                found[i] += [(m.start(), order, m.end(), kind) for m in pattern.finditer(texts[i]) if accept(m)]
        return [[(kind, low, high) for low, _, high, kind in sorted(spans)] for spans in found]


SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secret_spans``: an array of (kind, start, end), code points, end exclusive, by start, then rule.

    Matches are leftmost and do not overlap within a kind. Null and empty texts have none; texts are read whole; rows
    are independent, so repeated rows and nulls elsewhere change nothing. A column of this name is replaced.
    """

    def start():
        scanner = Scanner(rules)

        def compute(texts: list[str]) -> list[list]:
            return [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans] for spans in scanner.scan(texts)]]

        return compute

    return add_columns(docs, text, StructType([StructField("secret_spans", ArrayType(SPAN))]), start)


def secret_digests(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of their spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    base = [r.kind for r in BASE]

    def counted(kind: str):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[counted(k) for k in base],
        F.sha2(written(F.filter("secret_spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        written(F.col("secret_spans")).alias("spans"),
    )
