"""A training corpus from raw documents: quality rules, near-duplicates, benchmark passages, personal data, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``, with the rows they keep:

* ``quality``: documents that fail the base rules or reach a risk-controlled cutoff go;
* ``near_duplicates``: of each component of near-duplicates the document with the smallest id stays;
* ``decontaminate``: documents of which benchmark windows hit a twentieth of the words or more go;
* ``personal_data``: all stay; finds are replaced by their kind in ``text``, and ``n_chars`` follows;
* ``encode``: one row per document with its token ids and digests of them and of the text they decode to.

Nulls, empty texts, repeated rows and empty tables have the results that the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import keep, table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.pieces import encode_documents, encoding_digests_of
from tidemark.llm.pii import redact_personal_data
from tidemark.llm.quality import keep_good
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.simhash import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact_personal_data(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoding_digests_of(encode_documents(docs.select("doc_id", "text"), tokenizer_file()), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("encode", encode),
]

#: SimHash components and token ids are beyond SQL; the tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
