"""Change feeds: Kafka topics, or files holding records of the same shape."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas
from tidelog.functions import codecs


def file_feed(
    spark: SparkSession, path: str, schema: T.StructType = schemas.KAFKA_RECORD, **options: str
) -> DataFrame:
    """A stream of the parquet files that appear under ``path``."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def line_feed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A stream of the text lines that appear under ``path``, in a column ``value``."""
    return spark.readStream.options(**options).text(path)


def starting_offsets(start: str | Mapping[str, Mapping[int, int]]) -> str:
    """A Kafka start position: ``earliest``, ``latest``, or offsets by topic and partition."""
    if isinstance(start, str):
        if start not in ("earliest", "latest"):
            raise ValueError("start is 'earliest', 'latest' or a mapping of offsets")
        return start
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in start.items()})


def kafka_feed(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str | Mapping[str, Mapping[int, int]] = "earliest",
    per_trigger: int | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """A Kafka topic. Needs the Kafka connector package on the cluster."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.options(**options)
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting_offsets(start))
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def decoded_changes(
    records: DataFrame, image: T.StructType = schemas.DEMO, seq: str = "offset", keep: Sequence[str] = ()
) -> DataFrame:
    """Transport records as changes (``seq``, ``op``, ``before``, ``after``, and columns to ``keep``).

    Records without a value, such as the tombstones a topic keeps after deletes, are not
    changes and are dropped.

    ``seq`` names the column carrying the source's total order. An offset is only such
    an order for a topic of one partition, or when no change moves between keys.
    """
    return codecs.with_value(records).select(
        F.col(seq).alias("seq"), codecs.envelope(F.col("value"), image).alias("envelope"), *keep
    ).select("seq", "envelope.*", *keep)


def after_offsets(records: DataFrame, start: Mapping[int, int]) -> DataFrame:
    """Records at or past the start offset of their partition; unlisted partitions start at 0."""
    floor = F.lit(0)
    for partition, offset in start.items():
        floor = F.when(F.col("partition") == partition, F.lit(offset)).otherwise(floor)
    return records.where(F.col("offset") >= floor)


def snapshot_then_changes(
    snapshot: DataFrame, changes: DataFrame, snapshot_seq: DataFrame
) -> DataFrame:
    """A snapshot as read changes, followed by the changes past the snapshot's position.

    ``snapshot_seq`` is the position as a frame of one row and one column. Apply the
    result with ``apply_reads=True``.
    """
    image = changes.schema["after"].dataType
    position = snapshot_seq.first()[0]
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in image.fields])
    reads = snapshot.select(
        F.lit(position).cast("long").alias("seq"),
        F.lit("r").alias("op"),
        F.lit(None).cast(image).alias("before"),
        row.alias("after"),
    )
    later = changes.where(F.col("seq") > position).select("seq", "op", "before", "after")
    return reads.unionByName(later)
