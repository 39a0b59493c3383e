"""What the operators share: row identity, scratch tables, and the held-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again.

    This cuts the lineage: what follows can be repeated after a lost executor without
    repeating what came before.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(divisor: int, doc_id: str = "doc_id") -> Column:
    """``crc32`` of the id as text, modulo ``divisor``; a NULL id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(divisor)
