"""The operators against plain Python on whole small tables and random input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from sentencepiece import SentencePieceProcessor

from tidemark.llm import html_text, masked_lm, pieces, pii, quality, secret_scan, sharding, simhash, toxicity
from tidemark.llm.components import components
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES, tokenizer_file

SF_DIR = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


def table(name):
    return duckdb.sql(f"select * from '{SF_DIR}/{name}.parquet'").fetchall()


def result(spark, name):
    return {r[0]: r.asDict() for r in QUERIES[name](spark, str(SF_DIR)).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def texts(df):
    """Rows as texts; whole numbers look alike whether or not their column holds nulls."""
    whole = df.apply(lambda c: c.astype("Int64") if c.dtype.kind in "if" and (c.dropna() % 1 == 0).all() else c)
    return sorted(map(tuple, whole.astype(str).values))


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = db.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, str(SF_DIR)).toPandas()[list(want.columns)]
    assert texts(got) == texts(want)


@needs_tables
@pytest.mark.parametrize("name", ["op4_quality", "op6_decontaminate", "op9_sharding"])
def test_results_do_not_depend_on_broadcasts(spark, monkeypatch, name):
    sent = result(spark, name)
    monkeypatch.setattr("tidemark.llm.common.BROADCAST_BYTES", -1)
    assert result(spark, name) == sent


def test_pieces_equal_the_library():
    model, library = pieces.PieceModel(tokenizer_file()), SentencePieceProcessor(model_file=tokenizer_file())
    rng = random.Random(1)
    parts = [*"ab the in  \n\r\t;){}é漢😀ß▁'́ \xa0", "  ", "    ", "\x00", "def ", "</s>", "<0x41>", "internationalization"]
    for k in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        if k % 10 == 0:
            text = " " * rng.randrange(70) + text + " " * rng.randrange(40)
        ids = library.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids)
    assert model.encode("a" * 50_000) == library.encode("a" * 50_000)
    assert model.decode([*library.encode("ok"), model.bytes[0xFF], model.bytes[0xE2]]) == "ok��"


@needs_tables
def test_encoding_query(spark):
    library, got = SentencePieceProcessor(model_file=tokenizer_file()), result(spark, "op3_sentencepiece")
    for doc_id, text, *_ in table("documents"):
        ids = library.encode(text or "", add_eos=True)
        row = got[doc_id]
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


@needs_tables
def test_near_duplicate_query(spark):
    prints = {}
    for doc_id, text, *_ in table("documents"):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        n = min(4, len(words))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(len(words) - n + 1)] if words else []
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
    got = result(spark, "op10_simhash")
    for doc_id, root in roots(prints).items():
        assert (got[doc_id]["fingerprint"], got[doc_id]["component_id"]) == (f"{prints[doc_id]:016x}", root)


def roots(values):
    parent = {i: i for i in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(values.items(), 2):
        if (x ^ y).bit_count() <= 4:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: find(i) for i in values}


def test_any_four_positions_hold_a_set():
    assert len(simhash.POSITION_SETS) == 20
    for four in combinations(range(8), 4):
        assert any(set(s) <= set(four) for s in simhash.POSITION_SETS)


def test_components_of_dense_and_drifting_fingerprints(spark):
    rng = random.Random(5)
    values, dense, chain = set(), rng.getrandbits(64), rng.getrandbits(64)
    for _ in range(150):
        x = dense
        for b in rng.sample(range(64), rng.randrange(6)):
            x ^= 1 << b
        values.add(x)
        for b in rng.sample(range(64), 4):
            chain ^= 1 << b
        values |= {chain, rng.getrandbits(64)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in signed], "v bigint")
    want = roots({v: v & (1 << 64) - 1 for v in signed})
    assert {r["value"]: r["root"] for r in simhash.close_components(frame, "v").collect()} == want


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 95), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 90, 90: 90, 95: 90}


@needs_tables
def test_measures(spark):
    got = result(spark, "op4_quality")
    for doc_id, text, *_ in table("documents"):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        times = Counter(windows)
        repeats = {p for k, w in enumerate(windows) if times[w] > 1 for p in range(k, k + 5)}
        lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        row = got[doc_id]
        assert [row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")] == [
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeats),
            len(words) < 10 or 100 * len(repeats) > 20 * len(words),
        ]


def test_allowed_false_rejections_are_exact(spark):
    from math import comb

    from pyspark.sql import functions as F

    for n in (0, 1, 50, 300, 2000):
        for alpha, level in ((0.02, 0.01), (0.1, 0.05)):
            best, total = -1, 0.0
            for k in range(n + 1):
                total += comb(n, k) * alpha**k * (1 - alpha) ** (n - k)
                if total > level:
                    break
                best = k
            row = spark.range(1).select(quality.allowed(F.lit(n).cast("bigint"), alpha, F.lit(level)).alias("k")).first()
            assert row["k"] == (best if n else -1)


def test_cutoffs_hold_their_risk(spark):
    rng = random.Random(2)
    rows = [("a", [rng.randrange(200), 0, 0, 0], True) for _ in range(3000)] + [("a", [rng.randrange(150, 900), 0, 0, 0], False) for _ in range(500)]
    rows += [("b", [5, 5, 5, 5], True)] * 3
    got = {r["stratum"]: r["cutoffs"] for r in quality.cutoffs(spark.createDataFrame(rows, "stratum string, values array<bigint>, good boolean")).collect()}
    cut = got["a"][0]
    assert cut and sum(v[0] >= cut for s, v, good in rows if good and s == "a") <= 0.005 * 3000
    assert sum(v[0] >= cut for s, v, good in rows if not good) > 300
    assert got["a"][1:] == [None] * 3 and got["b"] == [None] * 4


BASE_SECRETS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 16),
}


def base_secrets(text):
    order = list(BASE_SECRETS)
    found = sorted((m.start(), order.index(k), m.end()) for k, (p, ok) in BASE_SECRETS.items() for m in re.finditer(p, text, re.A) if ok(m))
    return [(order[k], a, b) for a, k, b in found]


def test_secrets_equal_plain_search():
    rng, scanner = random.Random(3), secret_scan.Scanner()
    parts = ["password", "PassWd", "Secret", "token", "api_key", "APIKEY", "AKIA", " ", ":", "=", '"', "'", "A1B2C3D4E5F6G7H8", "abc123", "0123456789abcdef", "é", "\n", "-", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)]
    for text, spans in zip(texts, scanner.scan(texts), strict=True):
        assert [s for s in spans if s[0] in BASE_SECRETS] == base_secrets(text)


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]{16,}") is None
    assert secret_scan.trigram_query("AKIA[A-Z]+") == ("and", ("aki", "kia"))
    assert secret_scan.trigram_query("(?:abcd|xyz)[0-9]") == ("or", (("and", ("abc", "bcd")), "xyz"))
    assert secret_scan.trigram_query("(?:abcd|[0-9])") is None
    texts = ["xoxb-1234567890ab", "none", "://", "https://me:hunter22@host", "ghp_" + "a" * 30]
    assert [[s[0] for s in spans] for spans in secret_scan.Scanner().scan(texts)] == [["chat_token"], [], [], ["url_login"], ["code_host_token"] + ["hex"]]


@needs_tables
def test_secret_query(spark):
    got = result(spark, "op5_secrets")
    for doc_id, text, *_ in table("documents"):
        spans = base_secrets(text or "")
        assert got[doc_id]["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        assert [got[doc_id][f"n_{k}"] for k in BASE_SECRETS] == [sum(s[0] == k for s in spans) for k in BASE_SECRETS]


def base_personal(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def holds(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text) if holds(k, m[0])]


def test_personal_data_equals_plain_search():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice("a1 @.-+()90 .com") for _ in range(rng.randrange(50)))
        assert pii.find_all(text)[0] == base_personal(text)


@needs_tables
def test_personal_data_query(spark):
    got = result(spark, "op8_pii")
    for doc_id, text, *_ in table("documents"):
        assert got[doc_id]["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base_personal(text or "")))


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("mail bob (at) example (dot) com now", "email", "bob (at) example (dot) com"),
        ("say a.b at site dot org.", "email", "a.b at site dot org"),
        ("vоb@exаmple.com", "email", "vоb@exаmple.com"),
        ("host ０１２.１.２.３ up", "ip", "０１２.１.２.３"),
        ("call plus one two three four five six seven eight nine zero now", "phone", "plus one two three four five six seven eight nine zero"),
        ("b​ob@ex​ample.com", "email", "b​ob@ex​ample.com"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, part):
    plain, hidden = pii.find_all(text)
    assert plain == [] and [(k, text[a:b]) for k, a, b in hidden] == [(kind, part)]


def test_plain_words_are_no_disguise():
    for text in ("we met at noon dot dot dot", "look at the house", "one two three", "été à la plage · fin"):
        assert pii.find_all(text) == ([], [])
    assert pii.redacted("a@b.c and 1.2.3.4") == "[EMAIL] and [IP]"


@needs_tables
def test_shards(spark):
    rows = list(result(spark, "op9_sharding").values())
    sizes = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in table("documents")}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == sizes
    shards = Counter(r["shard"] for r in rows)
    assert set(shards) == set(range(16)) and max(shards.values()) - min(shards.values()) <= 1
    for s, n in shards.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))


def test_shuffle_depends_on_rows_and_seed_alone(spark):
    rows = [(i, None if i % 7 else "x") for i in range(500)] + [(1, "same")] * 300
    frame = spark.createDataFrame(rows, "k bigint, v string")

    def placed(f, seed=1):
        return sorted((str(tuple(r)) for r in sharding.shuffled(f, 5, seed, bucket_rows=64).collect()))

    first = placed(frame)
    assert placed(frame.repartition(3, "v").orderBy("k")) == first and placed(frame, 2) != first
    order = [r["k"] for r in sorted(sharding.shuffled(frame.where("v is null"), 1, 1, 64).collect(), key=lambda r: r["slot"])]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.2


def test_written_shards_keep_slots(spark, tmp_path):
    out = sharding.write_shards(spark.createDataFrame([(i, f"t{i}") for i in range(40)], "k bigint, text string"), f"{tmp_path}/s", 4, bucket_rows=8)
    assert out.count() == 40 and Counter(r["shard"] for r in out.collect()) == dict.fromkeys(range(4), 10)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    scores, begins = rng.normal(size=9), np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], bool)
    start, steps = np.array([1.0, 0.4]), np.array([[2.0, 0.5], [0.3, 1.7]])
    nodes, edges = toxicity.marginals(scores, begins, start, steps)
    total, want = 0.0, np.zeros(9)
    for code in range(1 << 9):
        path = [code >> t & 1 for t in range(9)]
        weight = 1.0
        for t, s in enumerate(path):
            weight *= (start[s] if begins[t] else steps[path[t - 1], s]) * np.exp(scores[t] * s)
        total += weight
        want += weight * np.array(path)
    assert np.allclose(nodes[:, 1], want / total) and np.allclose(edges[1].sum(axis=0), nodes[1])


def test_toxic_words_are_found_on_held_out_texts():
    rng = random.Random(4)
    bad, plain = ["vilex", "vilon", "grotta"], [f"word{i}" for i in range(300)]

    def text(toxic):
        words = rng.choices(plain, k=60)
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(bad) + rng.choice(["", "s", "ing"])
        return " ".join(words)

    labels = [i % 4 == 0 for i in range(400)]
    model = toxicity.train([text(y) for y in labels], [int(y) for y in labels])
    tests = [(text(y), y) for y in [True] * 50 + [False] * 50]
    spans, chances = model.read([t for t, _ in tests])
    assert sum((model.document_score(p) >= 0.5) == y for p, (_, y) in zip(chances, tests, strict=True)) >= 97
    (t, _), own, p = tests[0], spans[0], chances[0]
    assert {t[a:b][:3] for (a, b), q in zip(own, p, strict=True) if q >= 0.5} <= {"vil", "gro"} and (p >= 0.5).any()


@needs_tables
def test_toxicity_query_ignores_held_out_labels(spark):
    got = result(spark, "op7_toxicity")
    for doc_id, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)


def test_network_slopes_equal_differences():
    model = html_text.BlockLabeller.random(np.random.default_rng(1))
    rng = np.random.default_rng(2)
    x, real = rng.normal(size=(5, 2, html_text.INPUTS)), np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], bool)
    y = rng.integers(0, 2, (5, 2)).astype(float)
    slopes, _ = model.slopes(x, real, y)
    for name, at in (("ahead_x", (3, 5)), ("ahead_h", (2, 7)), ("back_h", (1, 40)), ("back_b", (20,)), ("out", (4,))):
        kept = model.w[name][at]
        sides = []
        for step in (1e-5, -1e-5):
            model.w[name][at] = kept + step
            sides.append(model.slopes(x, real, y)[1])
        model.w[name][at] = kept
        assert abs((sides[0] - sides[1]) / 2e-5 - slopes[name][at]) < 1e-6


def test_blocks_of_bad_markup():
    page = "<!-- <p>no</p> --><p>a &lt; b<p>c<br>d</p><script>if (x < 1) '<p>'</script>x<ul><li>1<li>2</ul> 3 < 4 <foot"
    assert [b.text for b in html_text.blocks_of(page)] == ["a < b", "c d", "x", "1", "2", "3 < 4"]


def test_labeller_on_unseen_invented_pages():
    model, maker = html_text.trained(), html_text.PageMaker(12345)
    right = total = 0
    for _ in range(60):
        page, labels = maker.page()
        p = model.probabilities([html_text.features(html_text.blocks_of(page))])[0]
        right += int(((p >= 0.5) == np.array(labels)).sum())
        total += len(labels)
    assert right / total > 0.97


@needs_tables
def test_article_text_of_all_pages(spark):
    import html

    got = result(spark, "op1_html")
    for page_id, _, page in table("pages"):
        inside = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", inside[1].replace("<br>", " ")) if inside else []
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in parts)
        assert got[page_id]["text"] == "\n".join(b for b in blocks if b)


def test_language_model_slopes_equal_differences():
    net = {k: v.astype(float) for k, v in masked_lm.fresh_network(3).items()}
    rng = np.random.default_rng(0)
    row, at = masked_lm._laid_out([rng.integers(0, masked_lm.TOKENS, 30).astype(np.int32)])
    slopes = masked_lm.slopes(net, row, at)
    for name, index in (("vectors", (row[5], 3)), ("places", (1, 2)), ("shift", (4,)), ("group", (3, 9)), ("member", (row[7] // 32, 2, row[7] % 32))):
        kept, sides = net[name][index], []
        for step in (1e-4, -1e-4):
            net[name][index] = kept + step
            sides.append(masked_lm.log_probabilities(net, row, at).mean())
        net[name][index] = kept
        assert abs((sides[0] - sides[1]) / 2e-4 - slopes[name][index]) < 1e-4


def test_conditional_probabilities_add_up():
    net = masked_lm.fresh_network(3)
    edge = masked_lm.TOKENS
    total = 0.0
    for token in range(masked_lm.TOKENS):
        row = np.array([edge, 5, token, 7, edge, edge], np.int32)
        total += np.exp(masked_lm.log_probabilities(net, row, np.array([2])))[0]
    assert abs(total - 1) < 1e-3


@needs_tables
def test_language_model_learns(spark):
    from tidemark.llm.common import keep

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    words = masked_lm.Vocabulary.of(keep(masked_lm.word_counts(docs), "words"))
    before = masked_lm.pseudo_likelihoods(docs, words, masked_lm.fresh_network()).groupBy().sum("log_likelihood").first()[0]
    scored = masked_lm.pseudo_likelihoods(docs, words, masked_lm.train(docs, words))
    after = {r["doc_id"]: r for r in scored.collect()}
    assert sum(r["log_likelihood"] for r in after.values()) > 0.9 * before
    for doc_id, text, *_ in table("documents"):
        assert after[doc_id]["n_words"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
