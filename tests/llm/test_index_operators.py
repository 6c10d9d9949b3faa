"""Repeated lines, spelling variants and the Merkle manifest against plain Python, on awkward rows and tiny pieces."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import line_dedup, merkle, spelling

BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Repeated lines

LINE_DOCS = [
    (1, "A banner that many documents share\nbody one\n  a BANNER that many documents share \t"),
    (2, "a banner that many documents share\r\nshort\nshort"),
    (3, "a banner that many documents share"),
    (4, None),
    (5, ""),
    (6, "zwölf Kekse für Ünal und Ä\nin two only: a line of some length"),
    (7, "zwölf Kekse für ünal und Ä\nin two only: a line of some length"),
    (8, "zwölf Kekse für Ünal und Ä\n\n" + "éééééééééé" * 2),
    (9, "zwölf Kekse für Ünal und Ä\n" + "éééééééééé" * 2 + "\n" + "x" * 300_000),
    (None, "éééééééééé" * 2 + "\n" + "x" * 300_000 + "\nonly rows without ids have it"),
    (None, "only rows without ids have it"),
    (None, "only rows without ids have it\n" + "x" * 300_000),
    (10, "one row, told twice, counts as two\none row, told twice, counts as two"),
    (10, "one row, told twice, counts as two\none row, told twice, counts as two"),
    (11, "one row, told twice, counts as two"),
]


def plain_line_digests(rows):
    holders = defaultdict(list)
    split = [(text or "").split("\n") for _, text in rows]
    key = lambda line: lower(line.strip(BLANKS))
    for (doc, _), lines in zip(rows, split):
        for k in {key(line) for line in lines if len(key(line)) >= 20}:
            holders[k].append(doc)
    keeper = {k: max((d for d in docs if d is not None), default=None) for k, docs in holders.items() if len(docs) >= 3}
    out = []
    for (doc, _), lines in zip(rows, split):
        stay = [line for line in lines if key(line) not in keeper or keeper[key(line)] == doc]
        out.append((doc, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("everywhere", [True, False])
def test_lines_on_awkward_rows(spark, monkeypatch, everywhere):
    if not everywhere:
        for name, value in (("ARRAY_BYTES", -1), ("SHARD_KEYS", 2), ("PARTITION_PROBES", 2)):
            monkeypatch.setattr(line_dedup, name, value)
    docs = spark.createDataFrame(LINE_DOCS, "doc_id bigint, text string").repartition(3)
    got = sorted((tuple(r) for r in line_dedup.line_digests(docs).collect()), key=repr)
    assert got == plain_line_digests(LINE_DOCS)
    assert line_dedup.line_digests(docs.limit(0)).collect() == []


@pytest.mark.parametrize("everywhere", [True, False])
def test_lines_keep_other_columns(spark, monkeypatch, everywhere):
    if not everywhere:
        monkeypatch.setattr(line_dedup, "ARRAY_BYTES", -1)
    names = ["row", "made", "doc", "mark", "lost", "high", "low", "shard", "copy", "n_lines"]
    rows = [(i, "the very same line in all of them", *names) for i in range(4)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", *names[:-1], "n_lines", "n_dropped", "kept_text"]
    assert sorted((r["doc_id"], r["row"], r["kept_text"]) for r in got.collect()) == [(i, "row", "the very same line in all of them" if i == 3 else "") for i in range(4)]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1)), max_size=400))
def test_index_is_minimal_and_perfect(pairs):
    pairs = sorted(pairs)
    high, low = (np.array([p[k] for p in pairs], np.uint64) for k in (0, 1))
    order = np.arange(len(pairs))
    index = line_dedup.LineIndex.build(high, low, order, order, order >= 0)
    at = index.probe(high, low)
    assert sorted(at.tolist()) == order.tolist()
    assert (index.counts[at] == order).all() and (index.fingerprints[at] == low).all()
    again = line_dedup.LineIndex.of(index.arrays())
    assert (again.probe(high, low) == at).all()
    assert (again.probe(high, low + np.uint64(1)) == -1).sum() >= len(pairs) - sum((h, (l + 1) % 2**64) in set(pairs) for h, l in pairs)


def test_index_refuses_equal_hashes():
    same = np.array([5, 5], np.uint64)
    with pytest.raises(ValueError):
        line_dedup.LineIndex.build(same, same, same, same, same > 0)


# Spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    uses = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            uses[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in uses.items() if len(w) >= 5 and n >= 3}
    links = {w: [o for o in words if near(w, o)] for w in words}
    best = {w: min(o, key=lambda x: (-words[x], x)) for w, o in links.items() if o}
    form = {w: b for w, b in best.items() if words[b] >= 2 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(links[w]), words[form[w]] if w in form else None) for w, n in words.items()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé", min_size=0, max_size=7), min_size=1, max_size=60))
def test_composition_gives_every_near_pair_once(words):
    got = [frozenset(p) for p in spelling.Acceptor(sorted(words)).near()]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    states = spelling.Acceptor(sorted(a + b + "ing" for a in "abcd" for b in "xyz"))
    assert len(states.arcs) == 6 and sorted(states.suffixes(states.start))[0] == "axing"


@pytest.mark.parametrize("small", [False, True])
def test_variants_of_random_words(spark, monkeypatch, small):
    if small:
        for name, value in (("PART_WORDS", 3), ("PART_LETTERS", 2), ("COUNTED_WORDS", 7)):
            monkeypatch.setattr(spelling, name, value)
    rng = random.Random(5)
    base = ["colour", "Straße", "zebras", "éééééé", "xylophone", "letters"] + ["a" * n for n in range(5, 12)]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(40):
            word = rng.choice(base)
            if rng.random() < 0.3:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "x", word[at] * 2, "É"]) + word[at + 1 :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((rng.choice([doc, doc, None]), rng.choice([" ", "-", "×"]).join(words)))
    giant = "ab" * 3000
    rows += [(100 + i, f"{giant} {giant}c {giant[:3000]}q{giant[3000:]} w{'z' * 400} {'z' * 400}") for i in range(4)]
    rows += [(1, None), (2, ""), (None, None), (3, "123 !")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((tuple(r) for r in spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)
    assert got == plain_variants(rows)
    if small:
        assert spelling.spelling_variants(docs.limit(0)).collect() == []


# Merkle manifest


def climbed(nodes):
    """The top over ``nodes`` and each one's path."""
    paths = [[] for _ in nodes]
    level = [(h, [i]) for i, h in enumerate(nodes)]
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for run in runs:
            for at, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(h for h, _ in run[:at]), "".join(h for h, _ in run[at + 1 :])))
        level = [(sha("".join(h for h, _ in run)), [m for _, ms in run for m in ms]) for run in runs]
    return level[0][0], paths


def plain_evidence(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[g] = climbed([leaf(r, r[1]) for r in groups[g]])
    root, above = climbed([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above):
        for r, path in zip(groups[g], trees[g][1]):
            path = path + up
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            got = leaf(r, lower(r[1]) if struck and r[1] is not None else r[1])
            for before, after in path:
                got = sha(before + got + after)
            out.append((r[0], leaf(r, r[1]), trees[g][0], root, sha("".join(b + a for b, a in path)), got, got == root))
    return sorted(out, key=repr)


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def evidence(spark, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    return sorted((tuple(r) for r in merkle.tamper_evidence(docs).collect()), key=repr)


def test_manifest_of_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(i, f"Text {i}", "en", "s", i) for i in rng.sample(range(-300, 2000), 620)]
    rows += [(i, f"Text {i}", "de", None, None) for i in (rng.randrange(-(2**62), 2**62) for _ in range(70))]
    rows += [(63 - 64 * i, None, None, "s", 0) for i in range(9)]
    rows += [(7, "Same", "fr", "s", 4)] * 12 + [(7, f"Other {i}", "fr", "s", 4) for i in range(5)] + [(8, "ß", "fr", "s", 1), (None, "A", "fr", "s", 1), (None, None, "fr", None, None)]
    rows += [(2**63 - 1, "Last", "it", "s", 4)] + [(i, "X", f"l{i:02}", "s", 1) for i in range(20)] + [(1, "", "", "", 0), (2, "", "-", "", 0)]
    assert evidence(spark, rows) == plain_evidence(rows)


@pytest.mark.parametrize("n", [1, 9, 64, 513])
def test_heights_of_trees(spark, n):
    rows = [(3 * i, f"T{i}", "en", "s", i) for i in range(n)]
    assert evidence(spark, rows) == plain_evidence(rows)


def test_no_rows_no_manifest(spark):
    assert merkle.tamper_evidence(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_manifest_keeps_other_columns(spark):
    names = ["row", "g", "h", "i", "word", "bits", "n", "place", "slots", "path", "block", "top"]
    rows = spark.createDataFrame([(i, "en", sha(str(i)), *names) for i in range(10)], ["doc_id", "lang", "leaf", *names])
    got = merkle.manifest(rows, "lang", "doc_id", "leaf")
    assert got.columns == ["doc_id", "lang", "leaf", *[n for n in names if n != "path"], "subroot", "root", "path"]
    assert {(r["row"], r["block"], len(r["path"])) for r in got.collect()} == {("row", "block", 2)}
