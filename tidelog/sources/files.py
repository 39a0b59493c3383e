"""File listings and rows given in the program."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of the files under ``folder`` and the folders in it.

    Contents are not read. Files whose names begin with ``_`` or ``.`` are left out.
    """
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")


def inline_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType, view: str | None = None
) -> DataFrame:
    """Rows given in the program, with a declared schema, optionally as a temporary view."""
    df = spark.createDataFrame(list(rows), schema)
    if view:
        df.createOrReplaceTempView(view)
    return df
