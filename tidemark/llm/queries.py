"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import contamination_digests
from .html_text import main_texts
from .line_dedup import line_digests
from .masked_lm import corpus_scores
from .merkle import tamper_evidence
from .pieces import encoding_digests
from .pii import personal_data_digests
from .quality import quality_verdicts
from .secret_scan import secret_digests
from .sharding import shard_plan
from .simhash import near_duplicates
from .spelling import spelling_variants
from .toxicity import toxicity_scores


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op2_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_scores(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), tokenizer_file())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digests(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_plan(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_evidence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_masked_lm": op2_masked_lm,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_sharding": op9_sharding,
    "op10_simhash": op10_simhash,
    "op11_lines": op11_lines,
    "op12_spelling": op12_spelling,
    "op13_merkle": op13_merkle,
}
