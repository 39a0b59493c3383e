"""Keeping hot keys from landing in one task.

Two tools. ``hot_keys`` finds the keys worth separate treatment; its result is never
longer than ``max_keys``, so broadcasting it is safe at any data size, and whether a
key is listed changes only where its rows are processed, never the result.
``numbered`` ranks the rows of a group without bringing the group together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
SEGMENT = 1 << 20


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    *aggregates: Column,
    min_rows: int = HOT_ROWS,
    max_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """The most frequent keys of ``df`` with at least ``min_rows`` rows.

    The counts are combined before the shuffle, which therefore carries at most one
    row per key and input task.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_rows"), *aggregates)
    return (
        counted.where(F.col("hot_rows") >= min_rows)
        .orderBy(F.desc("hot_rows"), *keys)
        .limit(max_keys)
    )


def segment(order: str, width: int = SEGMENT) -> Column:
    """The range of ``width`` consecutive order values a row falls into."""
    return F.expr(f"`{order}` div {width}")


def numbered(
    df: DataFrame, parts: Sequence[str], order: str, name: str, width: int = SEGMENT
) -> DataFrame:
    """Add the row number within ``parts`` by ``order``, which is unique within ``parts``.

    Each group is cut into ranges of ``order``. A range holds at most ``width`` rows and
    is numbered by itself, then shifted by the count of the ranges before it; only those
    counts, one row per range, are summed in sequence.
    """
    cut = df.withColumn("seg", segment(order, width))
    sizes = cut.groupBy(*parts, "seg").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(*parts).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *parts, "seg", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift")
    )
    inside = F.row_number().over(Window.partitionBy(*parts, "seg").orderBy(order))
    return (
        cut.withColumn("inside", inside)
        .join(shifts, [*parts, "seg"])
        .withColumn(name, F.col("shift") + F.col("inside"))
        .select(*df.columns, name)
    )
