"""Putting transport records back in offset order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators import skew

POSITION = ("topic", "partition", "offset")


def distinct_records(records: DataFrame) -> DataFrame:
    """One record per (topic, partition, offset); redelivered copies merge before the shuffle."""
    rest = [c for c in records.columns if c not in POSITION]
    if not rest:
        return records.groupBy(*POSITION).agg()
    merged = records.groupBy(*POSITION).agg(F.min(F.struct(*rest)).alias("rest"))
    return merged.select(*POSITION, "rest.*").select(*records.columns)


def resequence(records: DataFrame, width: int = skew.SEGMENT) -> DataFrame:
    """Each record once, with the contiguous run of offsets it belongs to.

    ``run`` is offset minus rank, so it is constant along consecutive offsets and
    rises by the number of missing offsets at each gap.
    """
    ranked = skew.numbered(
        distinct_records(records), ("topic", "partition"), "offset", "rank", width
    )
    return ranked.withColumn("run", F.col("offset") - F.col("rank")).drop("rank")


def in_offset_order(records: DataFrame) -> DataFrame:
    """Sort by position with a range shuffle, so one busy partition spreads over many tasks."""
    return records.repartitionByRange(*POSITION).sortWithinPartitions(*POSITION)
