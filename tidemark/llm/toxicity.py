"""Toxic spans and document scores by a linear-chain conditional random field, in numpy.

Labels mark documents, not words, so the training words get theirs from them: a word of a toxic document is toxic if it,
or its beginning, occurs in far more toxic than clean documents of the sample. A chain of two states with hashed word
features is trained on these sequences by gradient ascent of the conditional likelihood. Forward-backward marginals give each
word's probability of being toxic; words at a half or more are the offending spans, and a logistic function of
what the marginals add up to, fitted on the same documents, is the document's score.

Only ``text`` enters a score. The sample is bounded: SAMPLE_DOCS documents of either label and SAMPLE_CHARS characters each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from .common import add_columns

SAMPLE_DOCS = 1000
SAMPLE_CHARS = 6000
FOLDS = 5
BUCKETS = 1 << 16
ROUNDS = 20
CACHED_WORDS = 300_000

_WORD = re.compile(r"[^\W_]+")
#: A word or beginning in at least so many toxic documents, and so many times as often as in clean ones, is toxic.
LEAST_DOCS, TIMES = 4, 25


def _beginnings(word: str) -> list[str]:
    return [word, *(word[:n] for n in (4, 5, 6) if n < len(word))]


def word_features(word: str) -> list[int]:
    """Buckets of the word, its beginnings and its end; bucket 0 is common to all words."""
    names = [f"w{word}", *(f"b{word[:n]}" for n in (3, 4, 5, 6)), f"e{word[-3:]}"]
    return [0, *(1 + zlib.crc32(n.encode()) % (BUCKETS - 1) for n in names)]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, begins: np.ndarray, start: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact forward-backward over many texts at once: node (n, 2) and edge (n, 2, 2) marginals.

    ``scores`` are the words' log-odds of state 1, ``begins`` marks first words, ``start`` and ``steps`` are potentials. The texts
    form one chain that forgets its state where a text begins. The chain is laid out in columns; matrix products of
    whole columns carry states from one column to the next, so the loops are as long as a column, not as the longest text.
    Edges into first words are zero.
    """
    n = len(scores)
    rows = max(1, int(np.sqrt(n)))
    columns = -(-n // rows)
    emit = np.stack([np.ones(n), np.exp(np.clip(scores, -30, 30))], axis=1)
    emit /= emit.sum(axis=1, keepdims=True)
    moves = np.where(begins[:, None, None], start[None, None, :], steps[None]) * emit[:, None, :]
    moves = np.concatenate([moves, np.broadcast_to(np.eye(2), (rows * columns - n, 2, 2))])
    moves = moves.reshape(columns, rows, 2, 2).transpose(1, 0, 2, 3)
    whole = np.broadcast_to(np.eye(2), (columns, 2, 2))
    for t in range(rows):
        whole = whole @ moves[t]
        whole = whole / whole.sum(axis=(1, 2), keepdims=True)
    into = np.empty((columns, 2))
    out = np.empty((columns, 2))
    into[0], out[-1] = 0.5, 0.5
    for c in range(1, columns):
        into[c] = _normal(into[c - 1] @ whole[c - 1])
    for c in range(columns - 1, 0, -1):
        out[c - 1] = _normal(whole[c] @ out[c])
    before = np.empty((rows, columns, 2))
    ahead = np.empty((rows, columns, 2))
    state = into
    for t in range(rows):
        before[t] = state
        state = _normal(np.einsum("ci,cij->cj", state, moves[t]))
    state = out
    for t in range(rows - 1, -1, -1):
        ahead[t] = state
        state = _normal(np.einsum("cij,cj->ci", moves[t], state))
    edges = before[..., :, None] * moves * ahead[..., None, :]
    edges = edges.transpose(1, 0, 2, 3).reshape(-1, 2, 2)[:n]
    edges = edges / edges.sum(axis=(1, 2), keepdims=True)
    nodes = edges.sum(axis=1)
    return nodes, np.where(begins[:, None, None], 0.0, edges)


class ToxicChain:
    """Trained weights: hashed word features, chain potentials and the document's logistic function."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, final: np.ndarray) -> None:
        self.weights, self.chain, self.final = weights, chain, final
        self.known: dict[str, float] = {}

    def score_of(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            value = float(self.weights[word_features(word)].sum())
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = value
        return value

    def potentials(self) -> tuple[np.ndarray, np.ndarray]:
        return np.exp(self.chain[:2]), np.exp(self.chain[2:]).reshape(2, 2)

    def read(self, texts: list[str]) -> tuple[list[list[tuple[int, int]]], list[np.ndarray]]:
        """Word ranges of each text, and their probabilities of being toxic."""
        lowered = [_lower(t) for t in texts]
        spans = [[m.span() for m in _WORD.finditer(t)] for t in lowered]
        sizes = [len(s) for s in spans]
        if not sum(sizes):
            return spans, [np.zeros(0)] * len(texts)
        scores = np.array([self.score_of(t[a:b]) for t, own in zip(lowered, spans, strict=True) for a, b in own])
        begins = np.zeros(len(scores), bool)
        ends = np.cumsum(sizes)
        begins[(ends - sizes)[np.array(sizes) > 0]] = True
        nodes, _ = marginals(scores, begins, *self.potentials())
        return spans, np.split(nodes[:, 1], ends[:-1])

    def document_score(self, probabilities: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(summary(probabilities) @ self.final, -30, 30))))


def _lower(text: str) -> str:
    """Lower case without a change of length, so ranges stay those of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def summary(probabilities: np.ndarray) -> np.ndarray:
    """What a document's marginals add up to: a constant, the expected toxic words, their share, and the largest."""
    if not len(probabilities):
        return np.array([1.0, 0.0, 0.0, 0.0])
    total = float(probabilities.sum())
    return np.array([1.0, np.log1p(total), 10 * min(0.1, total / len(probabilities)), float(probabilities.max())])


def train(texts: list[str], toxic: list[int]) -> ToxicChain:
    """A chain from documents with labels; without either label all scores are the share of toxic ones."""
    labels = np.array(toxic, float)
    zero = ToxicChain(np.zeros(BUCKETS, np.float32), np.zeros(6), np.zeros(4))
    if not len(labels) or labels.min() == labels.max():
        share = np.clip(labels.mean() if len(labels) else 0.0, 0.01, 0.99)
        zero.final[0] = np.log(share / (1 - share))
        return zero
    words = [_WORD.findall(_lower(t)) for t in texts]
    seen = (Counter(), Counter())
    for own, label in zip(words, toxic, strict=True):
        seen[label].update({b for w in own for b in _beginnings(w)})
    ratio = labels.sum() / (len(labels) - labels.sum())
    marked = {k for k, n in seen[1].items() if n >= LEAST_DOCS and n >= TIMES * ratio * (seen[0][k] + 0.5)}
    wordy = [i for i, own in enumerate(words) if own]
    flat = [(w, bool(toxic[i]) and any(b in marked for b in _beginnings(w))) for i in wordy for w in words[i]]
    if not flat:
        return train([], toxic[:0])
    sizes = np.array([len(words[i]) for i in wordy])
    begins = np.zeros(len(flat), bool)
    begins[np.cumsum(sizes) - sizes] = True
    table = {w: word_features(w) for w, _ in flat}
    features = np.array([table[w] for w, _ in flat])
    states = np.array([s for _, s in flat], float)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (states[:-1].astype(int)[~begins[1:]], states[1:].astype(int)[~begins[1:]]), 1)
    firsts = np.bincount(states[begins].astype(int), minlength=2)
    weights = np.zeros(BUCKETS)
    weights[0] = -2.0
    chain = np.zeros(6)
    squares, chain_squares = np.full(BUCKETS, 1e-2), np.full(6, 1e-2)
    model = zero
    for _ in range(ROUNDS):
        model = ToxicChain(weights, chain, zero.final)
        nodes, edges = marginals(weights[features].sum(axis=1), begins, *model.potentials())
        missing = states - nodes[:, 1]
        slope = np.bincount(features.ravel(), np.repeat(missing, features.shape[1]), BUCKETS) - 0.05 * weights
        chain_slope = np.concatenate([firsts - nodes[begins].sum(axis=0), (pairs - edges.sum(axis=0)).ravel()]) - 0.05 * chain
        squares += slope**2
        chain_squares += chain_slope**2
        weights = weights + 0.6 * slope / np.sqrt(squares)
        chain = chain + 0.3 * chain_slope / np.sqrt(chain_squares)
    model = ToxicChain(weights.astype(np.float32), chain, zero.final)
    _, probabilities = model.read(texts)
    model.final = _logistic(np.array([summary(p) for p in probabilities]), labels)
    model.known = {}
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a light ridge; rare labels count as much as frequent ones."""
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w + np.linalg.solve(curve, x.T @ (weight * (y - p)) - 1e-2 * w)
    return w


def in_holdout():
    return (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1)) % FOLDS) == 0


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """At most SAMPLE_DOCS texts of either label, outside the held-out fold, in an order of hashes; equal texts count once."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~in_holdout()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
    # Only ids and digests are joined and grouped; texts are read again for the few that are picked.
    digests = short.select("doc_id", F.md5("text").alias("digest"))
    joined = digests.join(known, "doc_id").groupBy("toxic", "digest").agg(F.min("doc_id").alias("doc_id"))
    picked = None
    for label in (0, 1):
        part = joined.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
        picked = part if picked is None else picked.unionByName(part)
    ids = picked.select("doc_id", "toxic")
    rows = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("probability", FloatType())])


def toxic_spans(docs: DataFrame, model: ToxicChain, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``toxic_spans``: words (start, end, probability) more likely toxic than not.

    Null and empty texts have no words and the score of such a text; texts are read whole; equal texts get equal
    results; an empty frame gives an empty frame. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.chain, model.final))

    def start():
        chain = ToxicChain(*shared.value)

        def compute(texts: list[str]) -> list[list]:
            spans, probabilities = chain.read(texts)
            found = [
                [{"start": own[i][0], "end": own[i][1], "probability": float(p[i])} for i in np.flatnonzero(p >= 0.5)]
                for own, p in zip(spans, probabilities, strict=True)
            ]
            return [[chain.document_score(p) for p in probabilities], found]

        return compute

    made = StructType([StructField("score", DoubleType()), StructField("toxic_spans", ArrayType(SPAN))])
    return add_columns(docs, text, made, start)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` with a model trained on ``labels`` outside the held-out fold.

    A null id is not held out and has no label; null labels and ids count for nothing; of several labels the highest holds.
    """
    model = train(*training_sample(docs, labels))
    scored = toxic_spans(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", in_holdout().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
