"""From raw documents to a training mix, in five stages.

Every stage reads what its predecessor wrote and returns the columns of ``documents``;
the last adds ``copies``, how often the mix repeats a row.

* ``language_id``: texts without letters, and those of which less than ``CONFIDENT`` is
  known in any language, go. Languages are learned from the rows that name theirs.
* ``line_dedup``: runs of three lines or of eight words, and whole texts, that occurred
  before are deleted; a document that had words and keeps none goes. ``n_chars`` follows the text.
* ``near_dup``: of documents with 80 % of their five-word shingles in common the one
  with the smallest id stays, once. Texts that share an id, or have none, are documents of
  their own.
* ``decontamination``: documents that hold a benchmark item go.
* ``mixing``: sources are mixed to their targets; documents that the mix leaves out go.

A NULL text is one without letters. Columns beyond those of ``documents`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, language, line_dedup, mixing, near_dup
from tidelog.llm.common import WORD, remainder, stored, table

CONFIDENT = 0.3

#: The language models and the link graph are not expressible in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = language.learn(docs.where(remainder(5) != 0))
    found = language.identify(docs, filters)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= CONFIDENT)
    return found.where(known).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.delete_repeated_lines(docs)
    left = cut.where((F.col("n_deleted") == 0) | F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("near_dup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``; what each stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
