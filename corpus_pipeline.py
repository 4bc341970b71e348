"""A corpus pipeline of five stages, each over all that the stage before it kept.

    quality rules -> near-dedup -> benchmark decontamination -> mixing -> token files

Every stage is a function of (spark, docs, sf_dir). run() writes each result as Parquet to
the shared folder and reads it again, so a lost executor never costs more than one stage.
All but the last return the columns of documents.

Defined cases: null and empty texts fail the quality rules. Of rows of equal doc_id and text,
and of near duplicates, one stays; mixing may take a document several times, or not at all,
and token files hold it as often. Other columns pass through and may have any names. An empty
table gives empty stages and no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playpulse.llm import line_quality, mixing, near_dedup, queries, winnowing
from playpulse.llm.scratch import new_folder, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common lines of a host are taken out of its documents; those that this depletes, and
    those that fail the base rules, go."""
    ship(spark)
    return line_quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    ship(spark)
    return near_dedup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    ship(spark)
    return winnowing.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the target weights of their domains ask."""
    ship(spark)
    labels = queries.domain_labels(_table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labels, queries.TARGETS, keep="clean")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files are written and read back: one row for each document in them."""
    ship(spark)
    return queries.token_table(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_files),
]

#: The tokenizer cannot be expressed in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to the rows of the token files."""
    ship(spark)
    docs = _table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
