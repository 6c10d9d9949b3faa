"""Every operator and pipeline stage on awkward rows: nulls, empty and very long texts, repeats, no rows, clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, html_text, line_dedup, masked_lm, merkle, pieces, pii, quality, secret_scan, sharding, simhash, toxicity
from tidemark.llm.queries import QUERIES, tokenizer_file

CLASHING = ["row", "made", "words", "ids", "decoded", "digest", "place", "fingerprint", "stratum", "values", "kept", "score", "spans", "SHARD", "slot", "slot_", "record", "bucket", "copy"]
LONG = "plain words about ordinary things and others " * 4000


@pytest.fixture(scope="module")
def docs(spark):
    same = (4, "one and the same text in two rows of this table, told twice", "en", "s", 59)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", "en", "s", 4),
        same,
        same,
        (None, "a text without an id that is long enough to be kept by all rules", "de", None, 64),
        (5, LONG, "en", "s", len(LONG)),
        (6, "mail me at jo@example.com or call +1 (555) 010-2030 today please and thank you", "en", "s", 78),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, None)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "a text without an id"), (3, "a text without an id"), (None, "told twice")], "item_id bigint, text string")


def operators(labels, items):
    model = toxicity.train(["bad words here", "good words there"], [1, 0])
    counts = masked_lm.Vocabulary(["and", "others"], {0: 3})
    return {
        "op2": lambda d: masked_lm.pseudo_likelihoods(d, counts, masked_lm.fresh_network()),
        "op3": lambda d: pieces.encode_documents(d, tokenizer_file()),
        "op4": lambda d: quality.quality_verdicts(d, labels),
        "op5": secret_scan.find_secrets,
        "op6": lambda d: decontaminate.contamination_digests(d, items),
        "op7": lambda d: toxicity.toxic_spans(d, model),
        "op8": pii.find_personal_data,
        "op9": sharding.shard_plan,
        "op10": simhash.near_duplicates,
        "op11": line_dedup.drop_repeated_lines,
        "op13": merkle.tamper_evidence,
    }


@pytest.mark.parametrize("name", ["op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11", "op13"])
def test_one_row_for_each_document(spark, docs, labels, items, name):
    run = operators(labels, items)[name]
    got = sorted((r["doc_id"] for r in run(docs).collect()), key=str)
    assert got == [1, 2, 3, 4, 4, 5, 6, None]
    assert run(docs.limit(0)).collect() == []


def test_values_of_awkward_rows(docs, labels, items):
    by_id = {r["doc_id"]: r for r in quality.quality_verdicts(docs, labels).collect()}
    assert [by_id[i]["n_words"] for i in (1, 2, 3)] == [0, 0, 0] and by_id[1]["base_failed"]
    assert by_id[5]["n_repeat_words"] == 28000 and not by_id[5]["kept"] and by_id[4]["kept"]
    hit = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.contamination_digests(docs, items).collect()}
    assert hit[None] == (5, 1, True) and hit[4] == (2, 1, True) and hit[1] == (0, 0, False) and hit[5] == (0, 0, False)
    near = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert near[1] == near[2] == near[3] == ("0" * 16, 1) and near[4][1] == 4 and near[None][1] is None
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in sharding.shard_plan(docs).collect()}
    assert sizes[1] == sizes[2] == (1, 0)
    found = {r["doc_id"]: [s["kind"] for s in r["plain_spans"]] for r in pii.find_personal_data(docs).collect()}
    assert found[6] == ["email", "phone"] and found[1] == []


def test_other_columns_are_kept(docs):
    out = secret_scan.find_secrets(docs)
    assert out.columns == [*docs.columns, "secret_spans"]
    assert {r["row"] for r in out.collect()} == {"x0"}


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stage_returns_the_columns_it_got(spark, docs, tables, name, stage):
    got = stage(spark, docs, tables)
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    rows = got.collect()
    ids = sorted((r["doc_id"] for r in rows), key=str)
    assert ids == {
        "quality": [4, 4, 6, None],
        "near_duplicates": [1, 4, 5, 6, None],
        "decontaminate": [1, 2, 3, 5, 6],
        "personal_data": [1, 2, 3, 4, 4, 5, 6, None],
    }[name]
    if name == "personal_data":
        by_id = {r["doc_id"]: r for r in rows}
        assert by_id[6]["text"] == "mail me at [EMAIL] or call [PHONE] today please and thank you"
        assert by_id[6]["n_chars"] == len(by_id[6]["text"]) and by_id[1]["text"] is None
    assert stage(spark, docs.limit(0), tables).collect() == []


@pytest.fixture(scope="module")
def tables(labels, items, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_pipeline_runs_its_stages_in_order(spark, tables):
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, tables).collect()}
    text = "mail me at [EMAIL] or call [PHONE] today please and thank you"
    assert got == {6: [*pieces.PieceModel(tokenizer_file()).encode(text), 2]}


def test_empty_tables(spark, tmp_path):
    for name, schema in {
        "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
        "labels": "doc_id bigint, quality int, toxic int",
        "benchmark": "item_id bigint, text string",
        "pages": "page_id bigint, url string, html string",
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p"), (4, "u", "just text"), (4, "u", "just text"), (None, "u", "<html><body><nav><ul><li><a href='/x'>home</a></li></ul></nav><article><h1>A &amp; B</h1><p>First\n part.<p>Second one.</article><footer>&copy; x</footer>")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1] == got[2] == got[3] == ("", 0)
    assert got[None] == ("A & B\nFirst part.\nSecond one.", 31 - 2)
