"""What the operators must not leave out."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import html_text, masked_lm, pii, sharding, toxicity
from tidemark.llm.common import keep, scratch, slices


def test_rare_words_keep_their_uses(spark):
    of_class = {}
    for i in range(1000):
        of_class.setdefault(zlib.crc32(f"r{i}".encode()) % masked_lm.RARE_CLASSES, []).append(f"r{i}")
    twice, once = next(words for words in of_class.values() if len(words) > 1)[:2]
    common = " ".join(f"w{i}" for i in range(masked_lm.FREQUENT))
    texts = [common] * 5 + [twice, twice, once, f"{twice} w1 {once}", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = masked_lm.Vocabulary.of(keep(masked_lm.word_counts(docs), "words"))
    got = {r["doc_id"]: r["log_likelihood"] for r in masked_lm.pseudo_likelihoods(docs, words, masked_lm.fresh_network()).collect()}
    assert len(got) == len(texts) and got[5] == got[6] and got[9] == got[10] == 0
    assert abs(got[5] - got[7] - math.log(3 / 2)) < 1e-5


def test_words_are_counted_and_encoded_by_the_block(spark):
    texts = [None, "", " \t", "a b a", "\x0ba\x0c\r\nb ", "a\u00a0b \u2003 x\x1cy\x85 \U0001f600", " a" * 1000, "é e\u0301 E a"]
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "k bigint, body string")
    counts = masked_lm.word_counts(docs, "body")
    assert {r["word"]: r["uses"] for r in counts.collect()} == Counter(chain.from_iterable(words))
    # A task hands on each word of a block of texts once, not one row per use.
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
    hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in ("x\x1cy\x85", "é")], np.uint64).view(np.int64)
    order = np.argsort(hashes)
    encoder = masked_lm.Encoder(["a", "E"], 960, hashes[order], np.array([5, 7])[order])
    tokens, logs = encoder.encode(pa.array([t or "" for t in texts]).slice(1))
    token = {"a": 0, "E": 1}
    assert [t.tolist() for t in tokens] == [[token.get(w, 960 + zlib.crc32(w.encode()) % masked_lm.RARE_CLASSES) for w in ws] for ws in words[1:]]
    assert np.allclose(logs, [sum({"x\x1cy\x85": math.log(5), "é": math.log(7)}.get(w, 0) for w in ws) for ws in words[1:]])


def test_blocks_are_bounded_in_bytes():
    texts = pa.array(["\u20ac" * 4, "abc", "", "\U0001f600" * 9, "d"])
    assert list(slices(texts, 16, "binary_length")) == [(0, 3), (3, 4), (4, 5)]
    assert list(slices(texts, 16)) == [(0, 4), (4, 5)]


def test_vocabulary_grows_with_the_corpus(spark):
    counts = spark.createDataFrame([(f"w{i}", 200) for i in range(2000)] + [("rare", 1)], "word string, uses bigint")
    words = masked_lm.Vocabulary.of(counts)
    assert len(words.frequent) == 2000 and words.groups**2 >= 2000 + masked_lm.RARE_CLASSES
    assert words.token("rare") >= words.first_class and sum(words.class_uses.values()) == 1
    docs = spark.createDataFrame([("w1 w2 rare w1999",)], "text string")
    net = masked_lm.train(docs, words)
    assert len(net["vectors"]) == words.groups**2 + 1
    assert masked_lm.pseudo_likelihoods(docs, words, net).first()["log_likelihood"] < 0


def test_training_predicts_every_word(spark):
    names = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(" ".join(names),)], "text string")
    net = masked_lm.train(docs, masked_lm.Vocabulary(names, {}))
    assert (net["member_bias"][0][:12] > 0).all() and (net["member_bias"][0][12:] < 0).all()


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("bob@example_dot_com", "email"),
        ("bob@example·com", "email"),
        ("bob﹫example.com", "email"),
        ("+44–20–7946–0958", "phone"),
        ("+44 ②0 7946 0958", "phone"),
        ("plus 4 four 2 zero 7 nine 4 six 0 nine", "phone"),
    ],
)
def test_every_transducer_runs_whatever_else_the_text_holds(text, kind):
    for around in ("", " x [at] y zero one "):
        assert (kind, 0, len(text)) in [x for side in pii.find_all(text + around) for x in side]


@pytest.mark.parametrize(
    "inside",
    ["<svg width=1 />", "<svg/>", "<object data=x>", "<audio src=x>", "<canvas/>", "<SCRIPT>no</SCRIPT>\u0130", "<svg/><svg><g/>no</SVG>", "<style>no</style >"],
)
def test_silent_tags_end_where_they_end(inside):
    assert [b.text.strip("\u0130 ") for b in html_text.blocks_of(f"<p>one</p>{inside}<p>two</p>") if b.text != "\u0130"] == ["one", "two"]


def test_raw_text_without_an_end_holds_the_rest():
    assert [b.text for b in html_text.blocks_of("<p>one</p><script/><p>two</p>")] == ["one"]


def test_shard_plan_is_read_from_whole_records(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 50) for i in range(40)], "doc_id bigint, text string")
    folders = lambda: set(Path(scratch(spark).removeprefix("file:")).glob("shards-*"))
    before = folders()
    plan = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_plan(docs, 4).collect()}
    (folder,) = folders() - before
    written = spark.read.parquet(str(folder)).collect()
    assert plan == {(r["doc_id"], r["shard"], r["slot"]) for r in written} and len(plan) == 40
    assert {(r["doc_id"], r["text"]) for r in written} == {tuple(r) for r in docs.collect()}


def test_whole_records_are_stored_once_and_files_hold_ranges(spark, tmp_path):
    size = lambda folder: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    kept = lambda: set(Path(scratch(spark).removeprefix("file:")).glob("*-*"))
    docs = spark.range(600).select("id", F.concat_ws(" ", *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 256) for i in range(40)]).alias("text"))
    docs = docs.unionByName(docs.where("id < 3"))
    before = kept()
    sharding.write_shards(docs, str(tmp_path / "s"), 7, bucket_rows=50)
    assert sum(map(size, kept() - before)) < size(tmp_path / "s") / 20
    slots = {}
    for f in sorted((tmp_path / "s").rglob("*.parquet")):
        found = [r["slot"] for r in spark.read.parquet(str(f)).select("slot").collect()]
        assert found == list(range(found[0], found[0] + len(found)))
        slots.setdefault(f.parent.name, []).extend(found)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sorted(map(len, slots.values())) == [86] * 6 + [87]


@pytest.mark.parametrize(("n", "shards"), [(0, 3), (1, 3), (2, 3), (3, 3), (50, 1), (50, 64)])
def test_shards_differ_by_one_at_most(spark, n, shards):
    rows = sharding.shuffled(spark.range(n), shards, bucket_rows=7).collect()
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(shards)}
    assert sorted(r["id"] for r in rows) == list(range(n)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(s == list(range(len(s))) for s in slots.values())


def test_buckets_follow_the_bytes(spark):
    short, long = (spark.createDataFrame([(i, "x" * n) for i in range(20)], "doc_id bigint, text string") for n in (10, 1 << 20))
    assert sharding.bucket_rows_for(short) == sharding.BUCKET_ROWS and 1 <= sharding.bucket_rows_for(long) <= 16


def test_a_common_banner_does_not_merge_training_texts(spark):
    banner = "a banner that every document of this source begins with, word for word: "
    rows = [(i, f"{banner} text {i // 2}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(80)], "doc_id bigint, toxic int")
    learned = {i for i in range(80) if zlib.crc32(str(i).encode()) % 5}
    texts, _ = toxicity.training_sample(docs, labels)
    assert sorted(texts) == sorted({text for i, text in rows if i in learned})


def _held_out_gain(spark, partitions):
    """Scores of pairs of words that always follow each other, and the same under the words' shares alone."""
    texts = [" ".join(f"a{(i * 7 + k) % 50} b{(i * 7 + k) % 50}" for k in range(40)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = keep(masked_lm.word_counts(docs), "words")
    words = masked_lm.Vocabulary.of(counts)
    net = masked_lm.train(docs.where("doc_id % 5 > 0").repartition(partitions), words)
    unseen = docs.where("doc_id % 5 = 0").repartition(partitions)
    trained, shares = (masked_lm.pseudo_likelihoods(unseen, words, n).collect() for n in (net, masked_lm.first_network(words)))
    return {r["doc_id"]: r["log_likelihood"] for r in trained}, sum(r["log_likelihood"] for r in shares)


def test_scores_do_not_depend_on_the_layout_and_beat_shares_of_words(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "REPLICA_WORDS", 10_000)
    one, shares = _held_out_gain(spark, 1)
    for partitions in (4, 32):
        other, _ = _held_out_gain(spark, partitions)
        assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-6 * abs(one[k]) for k in one)
    assert sum(one.values()) > 0.8 * shares


def test_rare_words_by_arrays_and_by_join(spark, monkeypatch):
    texts = ["x y x y z", "x " * 30, "y z q", None, "", "x y x y z"] + [" ".join(f"w{i}" for i in range(1200))] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(masked_lm, "FREQUENT", 20)
    words = masked_lm.Vocabulary.of(keep(masked_lm.word_counts(docs), "words"))
    net = masked_lm.first_network(words)
    arrays = {r["doc_id"]: r["log_likelihood"] for r in masked_lm.pseudo_likelihoods(docs, words, net).collect()}
    monkeypatch.setattr(masked_lm, "BROADCAST_BYTES", 0)
    joined = {r["doc_id"]: r["log_likelihood"] for r in masked_lm.pseudo_likelihoods(docs, words, net).collect()}
    assert len(arrays) == len(texts) and all(abs(arrays[k] - joined[k]) < 1e-6 for k in arrays)


def test_scores_equal_a_plain_computation(spark):
    names = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, "w1 w2 rare w3 odd odd"), (2, "w4"), (3, None)], "doc_id bigint, text string")
    rare = spark.createDataFrame([("rare", 5), ("odd", 2)], "word string, uses bigint")
    of_class = {}
    for word, n in (("rare", 5), ("odd", 2)):
        c = zlib.crc32(word.encode()) % masked_lm.RARE_CLASSES
        of_class[c] = of_class.get(c, 0) + n
    words = masked_lm.Vocabulary(names, of_class, rare)
    net = masked_lm.fresh_network(3)
    got = {r["doc_id"]: r["log_likelihood"] for r in masked_lm.pseudo_likelihoods(docs, words, net).collect()}

    def token(word):
        return names.index(word) if word in names else words.first_class + zlib.crc32(word.encode()) % masked_lm.RARE_CLASSES

    def softmax(scores):
        weights = [math.exp(s) for s in scores]
        return [w / sum(weights) for w in weights]

    for doc_id, text in ((1, "w1 w2 rare w3 odd odd"), (2, "w4"), (3, "")):
        tokens, total = [token(w) for w in text.split()], 0.0
        for i, word in enumerate(text.split()):
            hidden = []
            for d in range(masked_lm.WIDTH):
                x = float(net["shift"][d])
                for j, k in enumerate((-2, -1, 1, 2)):
                    near = tokens[i + k] if 0 <= i + k < len(tokens) else masked_lm.TOKENS
                    x += float(net["vectors"][near][d] * net["places"][j][d])
                hidden.append(math.tanh(x))
            g, m = divmod(tokens[i], masked_lm.GROUPS)
            for weights, bias, which in ((net["group"], net["group_bias"], g), (net["member"][g], net["member_bias"][g], m)):
                shares = softmax([sum(hidden[d] * float(weights[d][o]) for d in range(masked_lm.WIDTH)) + float(bias[o]) for o in range(masked_lm.GROUPS)])
                total += math.log(shares[which])
            if word not in names:
                total += math.log({"rare": 5, "odd": 2}[word] / of_class[zlib.crc32(word.encode()) % masked_lm.RARE_CLASSES])
        assert abs(got[doc_id] - total) < 1e-3
