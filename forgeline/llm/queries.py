"""Registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forgeline.llm import (
    decontaminate, hard_negatives, language_mix, license_scan, mixing, ordinal_quality, probminhash, quality_rules, sentence_pieces,
    token_alignment, token_orc, toxicity_crf, warc,
)
from forgeline.llm.common import documents
from forgeline.sources.tables import read_table


def op1_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.groups(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licensed(documents(spark, sf_dir)).selectExpr(
        "doc_id", "cast(size(matches) as bigint) as n_matches", "array_join(array_sort(array_distinct(matches.license)), ',') as licenses",
        "array_max(matches.coverage) as best_coverage", "cast(matches as string) as spans")


def op3_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_crf.scored(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")).selectExpr(
        "doc_id", "held_out", "score", "predicted", "size(spans) as n_spans")


def op4_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mix.identified(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir),
                                measures=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies_frame(documents(spark, sf_dir).select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_index(read_table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(
        documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_quality.graded(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")).selectExpr(
        "doc_id", "held_out", "expected_grade", "tails[0] as tail_1", "tails[1] as tail_2", "selected")


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.token_index(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "embedding", "if(vec_id % 7 = 0, (label + 1) % 10, label) as label")
    return hard_negatives.mined(rows, "vec_id % 100 = 0")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_report(documents(spark, sf_dir))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digest(sentence_pieces.decoded(sentence_pieces.encoded(documents(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_probminhash, op2_license_scan, op3_toxicity_crf, op4_language_mix, op5_quality_rules, op6_mix, op7_warc,
        op8_decontaminate, op9_ordinal_quality, op10_token_orc, op11_hard_negatives, op12_token_alignment,
        op13_sentence_pieces)
}
