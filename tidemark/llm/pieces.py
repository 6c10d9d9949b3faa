"""SentencePiece encoding and decoding of merge-type (BPE) models, exact, by backtracking.

A text's encoding is the only split into pieces in which every two neighbours are compatible: merging their characters
anew, best score first, gives the same two pieces back. So the encoder walks from left to right, tries at each position
the longest piece the Aho-Corasick automaton matches there, then shorter ones, and steps back where none fits. A position
that was left in vain is marked in a bitfield and never entered again, so the work stays in proportion to the text.

White space only starts pieces and never follows other characters inside one, so texts fall into short stretches that
are encoded on their own; frequent ones are remembered in a cache of bounded size.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import add_columns

SPACE = "▁"
#: Entries each cache of a worker holds at most; a full one starts anew.
CACHED = 300_000


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("llm-each-byte", _each_byte)


class Remembered(dict):
    """Values of a function by its argument: the latest ones, between ``most`` and twice as many; long strings are not kept."""

    def __init__(self, function: Callable, most: int) -> None:
        self.function, self.most, self.before = function, most, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class PieceModel:
    """A BPE model with byte fallback, read from a ``.model`` file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.end = model.eos_id()
        self.pieces = [model.id_to_piece(i) for i in range(count)]
        plain = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        self.bytes = {int(self.pieces[i][3:-1], 16): i for i in range(count) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        texts = set(plain)
        self.texts = [p.replace(SPACE, " ") if i in texts else "" for i, p in enumerate(self.pieces)]
        self.partial = {i for i, b in self.byte_of.items() if b >= 128}
        for i in self.byte_of.keys() - self.partial:
            self.texts[i] = chr(self.byte_of[i])
        letters = set("".join(self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has white space after other characters; stretches would not be independent")
        self.cut = "\n"
        if self.cut in letters:
            raise ValueError("a piece has a line feed; lines would not be independent")
        self.stretch = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.automaton = ahocorasick.Automaton()
        for piece in letters | set(self.ids):
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.letters = letters
        self.widest = max(map(len, self.ids))
        self.begins = Remembered(self.longest, CACHED)
        self.fits = Remembered(self.compatible, CACHED)
        self.bare = Remembered(self.stretch_ids, CACHED)
        self.spaced = Remembered(lambda word: self.stretch_ids(SPACE + word), CACHED)

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging neighbours, best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, pair: tuple[str, str]) -> bool:
        """Whether merging anew gives this pair of pieces back (an empty first one: the second alone)."""
        return self.merged("".join(pair)) == [p for p in pair if p]

    def split(self, text: str) -> list[str]:
        """Pieces of a text all of whose characters occur in pieces."""
        size, widest = len(text), self.widest
        reach, begins, fits = self.automaton.longest_prefix, self.begins, self.fits
        failed = bytearray(size // 8 + 1)
        path: list[str] = []
        left, at = "", 0
        option = begins[text[: reach(text[:widest])]]
        while True:
            while option:
                to = at + len(option)
                if not failed[to >> 3] >> (to & 7) & 1 and fits[left, option]:
                    break
                option = begins[option[:-1]]
            if option:
                path.append(option)
                if to == size:
                    return path
                left, at = option, to
                ahead = text[at : at + widest]
                option = begins[ahead[: reach(ahead)]]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                option = path.pop()
                at -= len(option)
                left = path[-1] if path else ""
                option = begins[option[:-1]]

    def longest(self, text: str) -> str:
        """The longest piece or single letter that ``text``, the beginning of some piece, begins with."""
        while text and text not in self.automaton:
            text = text[:-1]
        return text

    def stretch_ids(self, stretch: str) -> tuple[int, ...]:
        if self.letters.issuperset(stretch):
            whole = tuple(map(self.ids.get, self.split(stretch)))
            if None not in whole:
                return whole
        ids: list[int] = []
        run = 0
        for i, c in enumerate(chain(stretch, [None])):
            if c is not None and c in self.letters:
                continue
            for piece in self.split(stretch[run:i]) if i > run else []:
                known = self.ids.get(piece)
                ids.extend([known] if known is not None else [self.bytes[b] for b in piece.encode()])
            if c is not None:
                ids.extend(self.bytes[b] for b in c.encode())
            run = i + 1
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without begin or end id."""
        out: list[int] = []
        # A begin of text counts as a blank. Lines are independent: a line feed is in no piece.
        for k, line in enumerate(text.replace(SPACE, " ").split(self.cut) if text else []):
            words = line.split(" ")
            if k:
                out.extend(self.bare[self.cut])
            if "" in words:
                for stretch in self.stretch.findall((line if k else " " + line).replace(" ", SPACE)):
                    out.extend(self.bare[stretch])
            else:
                if k:
                    out.extend(self.bare[words.pop(0)])
                out.extend(chain.from_iterable(map(self.spaced.__getitem__, words)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte ids join to characters, control ids vanish, the first piece loses one leading blank."""
        texts, byte_of = self.texts, self.byte_of
        if ids and ids[0] not in byte_of and texts[ids[0]] and self.partial.isdisjoint(ids):
            return "".join(map(texts.__getitem__, ids)).removeprefix(" ")
        out: list[str] = []
        held = bytearray()
        first = True
        for i in ids:
            if i in byte_of:
                held.append(byte_of[i])
                first = False
                continue
            if held:
                out.append(held.decode("utf-8", "llm-each-byte"))
                held.clear()
            piece = texts[i]
            if first and piece:
                piece = piece.removeprefix(" ")
                first = False
            out.append(piece)
        out.append(held.decode("utf-8", "llm-each-byte"))
        return "".join(out)


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", end: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of int; the end id last if ``end``) and ``decoded``, the text those ids decode to.

    The model file is read on each executor from ``model_path``. A null or empty text has only the end id and decodes
    to an empty string; texts of any length are encoded whole; every row is handled on its own, so repeated rows and
    nulls in other columns change nothing; an empty frame gives an empty frame. Columns named ``ids`` or ``decoded`` are replaced.
    """

    def start():
        model = model_at(model_path)

        def compute(texts: list[str]) -> list[list]:
            ids = [model.encode(t) + [model.end] * end for t in texts]
            return [ids, [model.decode(i) for i in ids]]

        return compute

    made = StructType([StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    return add_columns(docs, text, made, start)


def encoding_digests_of(coded: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, the number of ids, digests of the ids and of the decoded text, and ``others``."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *others,
    )


def encoding_digests(docs: DataFrame, model_path: str) -> DataFrame:
    return encoding_digests_of(encode_documents(docs.select("doc_id", "text"), model_path))
