"""End-to-end jobs, each a composition of sources, operators and sinks.

Streaming jobs take ``trigger=None`` to process what is available and stop, or a
processing-time interval to keep running. A job restarted on its checkpoint goes on
where it stopped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas, storage
from tidelog.functions import codecs
from tidelog.operators import apply, changelog
from tidelog.sinks import files, tables
from tidelog.sinks.store import KeyedStore, VersionedStore
from tidelog.sources import feeds, jdbc
from tidelog.streaming.apply import start_apply_changes, start_upserts
from tidelog.streaming.commit import PARTS, PartitionCommitter
from tidelog.streaming.snapshot import Snapshot, SnapshotSource, plan_of


def changelog_job(
    records: DataFrame, path: str | None, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Change feed to changelog rows, landed at ``path`` or printed when it is None."""
    log = changelog.changelog(feeds.decoded_changes(records))
    if path is None:
        return files.start_console(log, checkpoint, trigger)
    return files.start_parquet(log, path, checkpoint, trigger)


def jdbc_to_parquet_job(
    spark: SparkSession,
    url: str,
    query: str,
    path: str,
    avro_schema: str = schemas.DEMO_AVRO_JSON,
    **read_options,
) -> None:
    """Database query to Parquet files of a record schema given as JSON text."""
    record = schemas.from_avro_json(avro_schema)
    rows = jdbc.read_query(spark, url, query, schemas.DEMO_WIDE, **read_options)
    files.write_parquet(codecs.typed_record(rows, record), path)


def image_log_job(
    records: DataFrame,
    path: str,
    checkpoint: str,
    bucket_ts: Column | None = None,
    form: str = "changelog",
    with_kind: bool = False,
    trigger: str | None = None,
    seq: str = "offset",
) -> StreamingQuery:
    """Change feed to hourly text files holding every row image.

    Deleted and replaced rows appear like any other, as the images do not say what
    happened to them; ``with_kind`` puts the row kind (or, in the retract form, the add
    flag) in front of each line.
    """
    decoded = codecs.with_value(records).withColumn("envelope", codecs.envelope(F.col("value")))
    log = changelog.changelog(decoded.select(F.col(seq).alias("seq"), "timestamp", "envelope.*"))
    mark = "row_kind"
    if form == "retract":
        log, mark = changelog.retractions(log), "is_add"
    line = codecs.text_line("Demo", schemas.COLUMNS)
    if with_kind:
        line = F.concat_ws(" ", F.col(mark).cast("string"), line)
    return files.start_rolling_text(log, line, path, checkpoint, bucket_ts, trigger)


def keyed_topic_job(
    records: DataFrame,
    path: str | None,
    checkpoint: str,
    trigger: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
) -> StreamingQuery:
    """Change feed to a keyed topic: files at ``path`` (``key``, ``value``, ``offset``), or Kafka.

    With ``servers`` and ``topic`` the records go to a Kafka topic, which needs the connector
    package. Kafka numbers them itself: one partition by key keeps the order of a key only if
    changes of it come in order. A row that moves to another key leaves a tombstone under its old one.
    """
    log = changelog.changelog(feeds.decoded_changes(records), schemas.KEYS)
    upserts = changelog.upsert_records(log, schemas.KEYS, schemas.COLUMNS)
    if servers is not None:
        return files.start_kafka(upserts, servers, topic, checkpoint, trigger)
    return files.start_parquet(upserts, path, checkpoint, trigger)


#: What orders the records of a topic.
LANES = ("topic", "partition")

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)


def topic_rows(topic: DataFrame, image: T.StructType = schemas.DEMO) -> DataFrame:
    """Keyed topic records as upserts (``id``, ``row``, ``seq``); a NULL value gives a NULL row."""
    keys = T.StructType([image[k] for k in schemas.KEYS])
    return topic.select(
        codecs.json_record(F.col("key"), keys).alias("key"),
        codecs.json_record(F.col("value"), image).alias("row"),
        F.col("offset").alias("seq"),
    ).select("key.*", "row", "seq")


def cdc_upsert_job(
    topic: DataFrame, store: VersionedStore, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Keyed topic to a table: decode, then upsert or delete by key, in the order of offsets."""
    return start_upserts(topic_rows(topic), store, checkpoint, trigger, deletes=True)


def cdc_apply_job(
    records: DataFrame, store: KeyedStore, checkpoint: str, trigger: str | None = None, **options
) -> StreamingQuery:
    """Change feed straight to a table: decode envelopes, then apply them by key.

    Partitions of the topic may run ahead of each other. ``start_apply_changes`` has the
    options; ``finish_changes`` is called when the feed has ended.
    """
    changes = feeds.decoded_changes(records, keep=LANES)
    return start_apply_changes(changes, store, checkpoint, trigger, LANES, **options)


def initial_stream_job(
    records: DataFrame,
    source: SnapshotSource,
    store: KeyedStore,
    checkpoint: str,
    chunk_rows: int = 10_000_000,
    trigger: str | None = None,
    **options,
) -> tuple[StreamingQuery, Snapshot]:
    """A table that changes, and its feed, to a copy: snapshot first, then the changes.

    The feed runs from the start; chunks of the table are read between its micro-batches.
    The copy is exact when the returned snapshot ``is_consistent``. Where the feed is idle, or
    ``trigger`` is None, ``Snapshot.finish`` reads the chunks that are left.
    """
    snapshot = Snapshot(store, source, plan_of(store, source, chunk_rows))
    return cdc_apply_job(records, store, checkpoint, trigger, snapshot=snapshot, **options), snapshot


def partitioned_table_job(
    topic: DataFrame,
    image: T.StructType,
    state: KeyedStore,
    committer: PartitionCommitter,
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Keyed topic to a time-partitioned table that only takes inserts.

    The topic is read as a changelog against the rows seen so far, so an update or a
    delete fails the batch instead of passing for an insert. ``image`` is the row shape,
    with ``create_time`` as the text partitions come from. With key filters in ``state``, a
    batch of new keys reads next to nothing of what was seen.
    """

    parts = codecs.partition_columns(F.col("create_time"))
    target = T.StructType(
        [*schemas.DEMO_WIDE.fields, T.StructField("event_time", T.TimestampType())]
        + [T.StructField(p, T.StringType()) for p in PARTS]
    )

    def seen_before(keys: DataFrame, feed: str, number: int) -> DataFrame:
        # Only the keys matter, so only they are read, and only where the batch may meet them.
        rows = state.read_matching(keys, feed, number)
        nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in image.fields}
        return rows.select(*[F.col(c) if c in state.keys else nothing[c] for c in image.names])

    def land(batch: DataFrame, number: int) -> None:
        feed = storage.feed_of(state.spark, checkpoint)
        # Kept on disk, so the source is not fetched and decoded for every use below.
        upserts = topic_rows(batch, image).persist(StorageLevel.DISK_ONLY)
        try:
            log = changelog.upsert_changelog(
                upserts, state.keys, "row", "seq", table=seen_before(upserts, feed, number)
            )
            rows = changelog.append_only(log).withColumn(
                "event_time", F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss")
            )
            rows = codecs.widen(rows.select("*", *parts), target)
            committer.process(rows, "event_time", number, feed)
            state.commit(apply.reduce_upserts(upserts, state.keys), feed, number)
        finally:
            upserts.unpersist()

    writer = topic.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()


def lines_to_table_job(lines: DataFrame, table: str, location: str, checkpoint: str) -> None:
    """Text lines to a table at ``location``: parse what has arrived and add it, each line once.

    A run writes its new lines only; those of earlier runs stay as they are.
    """
    parsed = lines.select(*codecs.delimited(F.col("value")))
    files.start_parquet(parsed, location, checkpoint, None).awaitTermination()
    lines.sparkSession.catalog.refreshTable(table)


def jdbc_insert_if_absent_job(
    spark: SparkSession,
    url: str,
    query: str,
    target: DataFrame,
    keys: Sequence[str] = schemas.KEYS,
    options: Mapping[str, str] | None = None,
    **read_options,
) -> DataFrame:
    """Database rows, carried as JSON, added to a table where their key is missing."""
    options = options or {}
    records = jdbc.read_json(spark, url, query, target.schema, options=options, **read_options)
    rows = records.select(codecs.json_record(F.col("record"), target.schema).alias("row"))
    # Database rows are unique by key, so there is no first one to pick.
    added = rows.select("row.*").withColumn("seq", F.lit(0))
    return apply.insert_if_absent(target, added, keys)
