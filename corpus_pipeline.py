"""The training-data pipeline: documents -> rules -> near-dedup -> decontamination -> mix -> token ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's docs. All but the last return the columns of
documents. Every stage works on all rows its predecessor kept.

Defined cases, for all stages: an empty table gives an empty table of the same columns; other columns pass through whatever they are called; a null in a
column that a stage does not read passes through; reruns agree. What a stage does with null and empty texts, null ids, ties and repeated rows stands at it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgeline.llm import decontaminate, mixing, probminhash, quality_rules, token_orc
from forgeline.llm.common import documents, materialized
from forgeline.sources.tables import read_table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go. Null and empty texts have no words and go; repeated rows are judged one by one."""
    return quality_rules.kept_rows(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the least id, then text digest. A null id is the largest; of rows that repeat id and
    text one stays; null, empty and white-space texts (none come here) would be groups of their own."""
    return probminhash.deduplicated(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; smaller matches are cut out of the text, and `n_chars`, if there, follows. Null texts stay null; an empty benchmark
    changes nothing; repeated rows are judged one by one."""
    return decontaminate.removed(docs, read_table(spark, sf_dir, "benchmark"),
                                 chars_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them. A null source is a source of its own; texts without words have size 0 and are sampled at
    their source's rate; repeated rows are numbered one by one."""
    return mixing.emit(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids in ORC files, indexed from the files: a row per document and copy, in ascending order of id. Null ids come first, copies of a
    document stand next to each other with a start of their own; null and empty texts have the end id alone."""
    return token_orc.token_index(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("mix", mix_sources),
    ("token_orc", write_token_ids),
]

#: MinHash grouping and the tokenizer are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
