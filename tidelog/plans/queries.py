"""One query per operator, source, sink and job, over the given tables.

Every query takes ``(spark, sf_dir)``. Those that exercise a sink or a stream write to
a fresh scratch folder and return what reads back from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import fixtures as fx
from tidelog import schemas
from tidelog.functions import codecs, kinds, variants
from tidelog.operators import apply, changelog, diff, sequence
from tidelog.plans import jobs
from tidelog.session import empty_frame, is_local, scratch_dir
from tidelog.sinks import files, packing, script, tables
from tidelog.sinks.store import KeyedStore, VersionedStore
from tidelog.sources import feeds, jdbc
from tidelog.sources import files as file_sources
from tidelog.streaming.apply import finish_changes, start_upserts
from tidelog.streaming.commit import PARTS, PartitionCommitter, start_partition_commit
from tidelog.streaming.resequence import released, start_resequence
from tidelog.streaming.snapshot import Snapshot, SnapshotSource, plan_of

Query = Callable[[SparkSession, str], DataFrame]

KEYS, COLUMNS = schemas.KEYS, schemas.COLUMNS
JDBC_URL_CONF = "spark.tidelog.jdbc.url"


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _record(alias: str = "row"):
    return F.struct(*COLUMNS).alias(alias)


# Sources


def _database(spark: SparkSession) -> str:
    """A database for the JDBC queries.

    A cluster names one every executor can reach. Locally an in-memory one serves,
    which only the process that made it can see.
    """
    url = spark.conf.get(JDBC_URL_CONF, None)
    if url:
        return url
    if not is_local(spark):
        raise ValueError(f"set {JDBC_URL_CONF} to a database the executors can reach")
    return f"jdbc:derby:memory:{_name('db')};create=true"


def _base_in_database(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    url, table = _database(spark), _name("demo")
    jdbc.write_table(fx.demo_base(spark, sf_dir), url, table)
    return url, f'select "id", "actor", "alias" from {table}'


def jdbc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, query = _base_in_database(spark, sf_dir)
    return jdbc.read_query(spark, url, query, schemas.DEMO_WIDE, split_by="id")


def jdbc_scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, query = _base_in_database(spark, sf_dir)
    return jdbc.read_json(spark, url, query, schemas.DEMO, split_by="id")


def jdbc_scan_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of which nine tenths lie in a thousandth of their range, read in ranges of equal depth."""
    url, table = _database(spark), _name("skewed")
    spread = F.when(F.col("id") % 20 == 0, F.col("id") * 1_000).otherwise(F.col("id"))
    jdbc.write_table(fx.demo_base(spark, sf_dir).withColumn("id", spread), url, table)
    query = f'select "id", "actor", "alias" from {table}'
    return jdbc.read_query(spark, url, query, schemas.DEMO_WIDE, split_by="id", equal_depth=True)


def cdc_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "cdc_feed")
    _write_feed(fx.envelope_records(spark, sf_dir), "offset", f"{folder}/feed")
    stream = feeds.decoded_changes(feeds.file_feed(spark, f"{folder}/feed"))
    files.start_parquet(stream, f"{folder}/out", f"{folder}/cp", None).awaitTermination()
    return _flat(spark.read.parquet(f"{folder}/out"))


def _flat(decoded: DataFrame) -> DataFrame:
    """Decoded changes with their images spread over plain columns."""
    images = [
        F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in COLUMNS
    ]
    return decoded.select("seq", "op", *images)


def start_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.dense_records(spark, sf_dir)
    return feeds.after_offsets(records, {}).select("partition", "offset")


def start_after_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.dense_records(spark, sf_dir)
    start = {0: 100, 1: 50}
    return feeds.after_offsets(records, start).select("partition", "offset")


def start_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.changes(spark, sf_dir)
    half = changes.agg(F.expr("max(seq) div 2").alias("position"))
    base = fx.demo_base(spark, sf_dir)
    feed = feeds.snapshot_then_changes(base, changes, half)
    nothing = empty_frame(spark, schemas.DEMO)
    return apply.apply_changes(nothing, feed, KEYS, apply_reads=True)


def kafka_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.row_records(spark, sf_dir)
    decoded = codecs.json_record(F.col("value"), schemas.DEMO)
    return records.select("seq", decoded.alias("row")).select("seq", "row.*")


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(feeds.decoded_changes(fx.envelope_records(spark, sf_dir)))


def _mixed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as JSON whose images lack fields, or have them in different types."""
    seq = F.col("seq")
    score = F.when(seq % 3 == 1, F.concat(F.lit(',"score":'), seq)).when(
        seq % 3 == 2, F.concat(F.lit(',"score":'), seq, F.lit(".5"))
    )
    note = F.when(seq % 4 == 0, ',"note":true').when(seq % 4 == 1, ',"note":"n"')
    more = F.concat(F.coalesce(score, F.lit("")), F.coalesce(note, F.lit("")), F.lit("}"))

    def image(side: str):
        known = F.to_json(F.col(side))  # without its NULLs
        whole = F.concat(F.substring(known, F.lit(1), F.length(known) - 1), more)
        return F.coalesce(F.when(F.col(side).isNotNull(), whole), F.lit("null"))

    parts = ('{"before":', image("before"), ',"after":', image("after"), ',"op":"', F.col("op"), '"}')
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return fx.changes(spark, sf_dir).select("seq", text.alias("value"))


def envelope_decode_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of unknown schema: agreed over the feed, then read as columns."""
    decoded = _mixed_envelopes(spark, sf_dir).select(
        "seq", variants.variant_envelope(F.col("value")).alias("envelope")
    ).select("seq", "envelope.*")
    schema = variants.agreed_schema(decoded)
    typed = decoded.select(
        "seq", "op", *[variants.typed_image(F.col(side), schema).alias(side) for side in ("before", "after")]
    )
    flat = [
        F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in schema.names
    ]
    return typed.select("seq", "op", *flat)


def raw_string_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.row_records(spark, sf_dir).select("seq", codecs.text(F.col("value")).alias("value"))


def delimited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.demo_base(spark, sf_dir).select(F.concat_ws(",", *COLUMNS).alias("value"))
    return lines.select(*codecs.delimited(F.col("value")))


def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows given in the program joined by the customers, queried through a view."""
    view = _name("person")
    given = file_sources.inline_rows(
        spark, [("Alice", 1), ("Bob", 2), ("Charlie", 3)], schemas.PERSON
    )
    people = fx.demo_base(spark, sf_dir).select(F.col("actor").alias("name"), "id")
    given.unionByName(people).createOrReplaceTempView(view)
    return spark.sql(f"SELECT name, id FROM {view}")


# Projection and changelogs


def op_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("seq") % 13 == 0, "x").when(F.col("seq") % 17 == 0, "t")
    code = code.otherwise(F.col("op"))
    return fx.demo_cdc(spark, sf_dir).select("seq", code.alias("op")).withColumn(
        "op_name", kinds.op_name(F.col("op"))
    )


def _log(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return changelog.changelog(fx.changes(spark, sf_dir).select("seq", "op", "before", "after"), keys)


def row_kind_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("seq") % 13 == 0, "?").otherwise(F.col("row_kind"))
    return _log(spark, sf_dir).select(
        "seq", "sub", kind.alias("row_kind"), kinds.row_kind_op(kind).alias("operation")
    )


def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _name("demo")
    fx.demo_base(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"SELECT id, actor FROM {view}")


def changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir)


def retract_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.retractions(_log(spark, sf_dir))


def changelog_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.images(_log(spark, sf_dir), COLUMNS)


def null_record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = fx.changes(spark, sf_dir).select("seq", F.col("after").alias("row"))
    return changelog.without_null_records(decoded, "row").select("seq", "row.*")


def upsert_kafka_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.upsert_records(_log(spark, sf_dir, *KEYS), KEYS, COLUMNS)


def upsert_kafka_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.upsert_table(fx.keyed_feed(spark, sf_dir), KEYS, "row", "seq")


def upsert_kafka_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.upsert_changelog(fx.keyed_feed(spark, sf_dir), KEYS, "row", "seq")


def typed_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codecs.typed_record(
        fx.demo_base(spark, sf_dir), schemas.from_avro_json(schemas.DEMO_AVRO_JSON)
    )


def widen_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codecs.widen(fx.demo_base(spark, sf_dir), schemas.DEMO_WIDE)


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    timed = events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time")
    )
    return timed.select("*", *codecs.partition_columns(F.col("create_time")))


def row_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.upserts(spark, sf_dir).select("seq", "row.*")
    return rows.select("seq", codecs.text_line("Demo", COLUMNS).alias("line"))


def resequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.gapped_records(spark, sf_dir).select("topic", "partition", "offset", "value")
    ordered = sequence.resequence(records)
    return ordered.select(
        "topic", "partition", "offset", codecs.text(F.col("value")).alias("value"), "run"
    )


# Table mutation


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.apply_changes(fx.demo_base(spark, sf_dir), fx.changes(spark, sf_dir), KEYS)


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes between the base table and what half of the feed makes of it."""
    base, changes = fx.demo_base(spark, sf_dir), fx.changes(spark, sf_dir)
    half = changes.agg(F.expr("max(seq) div 2")).first()[0]
    later = apply.apply_changes(base, changes.where(F.col("seq") <= half), KEYS)
    return _flat(diff.snapshot_changes(base, later, KEYS, seq=half))


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.upserts(spark, sf_dir).select("seq", "row.*")
    return apply.insert_if_absent(fx.demo_base(spark, sf_dir), rows, KEYS)


def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.demo_cdc(spark, sf_dir)
    doomed = feed.where("op = 'd'").select(F.col("before_id").alias("id"))
    return apply.delete_by_key(fx.demo_base(spark, sf_dir), doomed, KEYS)


def upsert_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.upsert(fx.demo_base(spark, sf_dir), fx.upserts(spark, sf_dir), KEYS)


def upsert_apply_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.keyed_feed(spark, sf_dir)
    return apply.upsert(fx.demo_base(spark, sf_dir), feed, KEYS, deletes=True)


def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.upserts(spark, sf_dir).select("seq", "row.*")
    return apply.update_by_key(fx.demo_base(spark, sf_dir), rows, KEYS)


# Sinks


def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "parquet_sink")
    files.write_parquet(typed_record(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def rolling_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "rolling_text")
    _write_feed(fx.envelope_records(spark, sf_dir), "offset", f"{folder}/feed")
    stream = feeds.file_feed(spark, f"{folder}/feed")
    query = files.start_rolling_text(
        stream, codecs.text(F.col("value")), f"{folder}/out", f"{folder}/cp",
        F.col("timestamp"), None,
    )
    query.awaitTermination()
    lines = spark.read.text(f"{folder}/out")
    decoded = lines.withColumn("envelope", codecs.envelope(F.col("value")))
    return decoded.select(
        F.col("bucket").cast("string").alias("bucket"),
        "envelope.op",
        F.col("envelope.before.id").alias("before_id"),
        F.col("envelope.after.id").alias("after_id"),
    )


PACK_CAP = 1_000


def rolling_text_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly folders of an image log, packed twice while it is landed: their files and lines."""
    folder = scratch_dir(spark, "rolling_text_pack")
    landed, packed = f"{folder}/landed", f"{folder}/files"

    def run() -> None:
        feed = feeds.file_feed(spark, f"{folder}/feed")
        jobs.image_log_job(feed, landed, f"{folder}/cp", F.col("timestamp")).awaitTermination()
        packing.pack(spark, landed, packed, PACK_CAP)

    _in_rounds(fx.envelope_records(spark, sf_dir), "offset", 2, f"{folder}/feed", run)
    files = packing.live_files(spark, landed, packed).groupBy("bucket").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
    lines = packing.read_packed(spark, landed, packed).groupBy("bucket").agg(F.count("*").alias("lines"))
    return files.join(lines, "bucket")


def partitioned_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, location = _timed_table(spark, "partitioned_insert")
    timed = fx.demo_timed(spark, sf_dir)
    rows = timed.select("id", "actor", "alias", *codecs.partition_columns(F.col("create_time")))
    target = spark.table(table).schema
    tables.partitioned_insert(codecs.widen(rows, target), table, PARTS)
    return spark.table(table)


def _timed_table(spark: SparkSession, label: str) -> tuple[str, str]:
    table, location = _name(label), scratch_dir(spark, label)
    schema = T.StructType(
        [*schemas.DEMO_WIDE.fields, *[T.StructField(p, T.StringType()) for p in PARTS]]
    )
    tables.create_table(spark, table, schema, location, PARTS)
    return table, location


def append_only_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By operation, how many rows its changes make, and whether the guard refuses them."""
    changes = fx.changes(spark, sf_dir).select("seq", "op", "before", "after")
    out = []
    for op in ("c", "r", "u", "d"):
        log = changelog.changelog(changes.where(F.col("op") == op))
        try:
            out.append((op, changelog.append_only(log).count(), False))
        except Exception as error:
            if "append-only" not in str(error):
                raise
            out.append((op, log.count(), True))
    return spark.createDataFrame(out, "op string, rows bigint, refused boolean")


def partition_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of the feed; the rows of the partitions published by then."""
    folder = scratch_dir(spark, "partition_commit")
    table, location = _timed_table(spark, "partition_commit")
    committer = PartitionCommitter(spark, table, location, f"{folder}/state")
    timed = fx.demo_timed(spark, sf_dir)
    rows = timed.select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.DEMO_WIDE.fields],
        F.col("ts").alias("event_time"),
        *codecs.partition_columns(F.col("create_time")),
        "seq",
    )

    def run() -> None:
        stream = feeds.file_feed(spark, f"{folder}/feed", rows.schema).drop("seq")
        start_partition_commit(
            stream, committer, "event_time", f"{folder}/cp", None
        ).awaitTermination()

    _in_rounds(rows, "seq", 3, f"{folder}/feed", run)
    return spark.table(table)


def partition_commit_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds into one table, of which the second lacks its last third."""
    folder = scratch_dir(spark, "partition_commit_feeds")
    table, location = _timed_table(spark, "partition_commit_feeds")
    committer = PartitionCommitter(
        spark, table, location, f"{folder}/state", feeds=("even", "odd")
    )
    timed = fx.demo_timed(spark, sf_dir)
    rows = timed.select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.DEMO_WIDE.fields],
        F.col("ts").alias("event_time"),
        *codecs.partition_columns(F.col("create_time")),
        "seq",
    )
    cuts = fx.cut_points(rows, "seq", 3)
    for name, rest, rounds in (("even", 0, 3), ("odd", 1, 1), ("odd", 1, 2)):
        # the even feed runs ahead; the odd one follows, a third at a time
        low = cuts[0] if name == "even" else cuts[rounds - 1]
        part = rows.where((F.col("seq") >= low) & (F.col("seq") < cuts[rounds]) & (F.col("seq") % 2 == rest))
        _write_feed(part, "seq", f"{folder}/{name}")
        stream = feeds.file_feed(spark, f"{folder}/{name}", rows.schema).drop("seq")
        start_partition_commit(
            stream, committer, "event_time", f"{folder}/cp-{name}", None, name
        ).awaitTermination()
    return spark.table(table)


def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, view = _name("people"), _name("source")
    tables.create_table(spark, table, schemas.PERSON, scratch_dir(spark, "insert_select"))
    people = fx.demo_base(spark, sf_dir).select(F.col("actor").alias("name"), "id")
    people.createOrReplaceTempView(view)
    tables.insert_select(spark, table, f"SELECT * FROM {view}")
    return spark.table(table)


def insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, view = _name("overwritten"), _name("source")
    tables.create_table(spark, table, schemas.LINE, scratch_dir(spark, "insert_overwrite"))
    base = fx.demo_base(spark, sf_dir)
    tables.insert(base.select("id", F.col("actor").alias("name")), table)
    base.select("id", F.col("alias").alias("name")).createOrReplaceTempView(view)
    tables.insert_select(spark, table, f"SELECT id, name FROM {view}", overwrite=True)
    return spark.table(table)


def text_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "text_append")
    base = fx.demo_base(spark, sf_dir)
    numbered = (F.col("id"), F.concat(F.lit("name"), F.col("id")))
    for _ in range(2):
        files.append_lines(base, folder, *numbered)
    return spark.read.text(folder).select(F.col("value").alias("line"))


def drop_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by day, after its first day is dropped."""
    table = _name("dated")
    events = fx.table(spark, sf_dir, "events")
    rows = events.select("event_id", F.date_format("ts", "yyyyMMdd").alias("ts_date"))
    tables.create_table(spark, table, rows.schema, scratch_dir(spark, "dated"), ["ts_date"])
    tables.partitioned_insert(rows, table, ["ts_date"])
    tables.drop_partition(spark, table, {"ts_date": "20240101"})
    return spark.table(table)


def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _name("source"), _name("target")
    fx.demo_base(spark, sf_dir).createOrReplaceTempView(source)
    location = scratch_dir(spark, "sql_script")
    script.run(
        spark,
        f"""
        CREATE TABLE {target} (id INT, actor STRING, alias STRING) USING parquet
          LOCATION '{location}';
        INSERT INTO {target} SELECT * FROM {source};
        ;
        INSERT INTO {target} SELECT id, 'a;b', alias FROM {source} WHERE alias = 'BUILDING';
        """,
    )
    return spark.table(target)


# Streaming


def _write_feed(feed: DataFrame, order: str, path: str) -> None:
    """Add a feed's records to a folder, in as many files as the session runs tasks."""
    tasks = feed.sparkSession.sparkContext.defaultParallelism
    feed.repartitionByRange(tasks, order).write.mode("append").parquet(path)


def _in_rounds(
    feed: DataFrame,
    order: str,
    rounds: int,
    path: str,
    run: Callable[[], None],
    turns: Sequence[int] | None = None,
) -> None:
    """Grow a file feed by ranges of ``order``, running a stream to its end after each.

    The ranges come in order, or as ``turns`` says.
    """
    cuts = fx.cut_points(feed, order, rounds)
    for turn in range(rounds) if turns is None else turns:
        low, high = cuts[turn], cuts[turn + 1]
        part = feed.where((F.col(order) >= low) & (F.col(order) < high))
        _write_feed(part, order, path)
        run()


def _base_store(
    spark: SparkSession, sf_dir: str, folder: str, kind: type[KeyedStore] = KeyedStore
) -> KeyedStore:
    store = kind(spark, f"{folder}/store", schemas.DEMO, KEYS, buckets=8)
    store.create(fx.demo_base(spark, sf_dir))
    return store


def _applied_in_rounds(spark: SparkSession, sf_dir: str, label: str, rounds: int) -> DataFrame:
    folder = scratch_dir(spark, label)
    store = _base_store(spark, sf_dir, folder)
    feed = fx.envelope_records(spark, sf_dir)

    def run() -> None:
        records = feeds.file_feed(spark, f"{folder}/feed")
        jobs.cdc_apply_job(records, store, f"{folder}/cp").awaitTermination()

    _in_rounds(feed, "offset", rounds, f"{folder}/feed", run)
    finish_changes(store)
    return store.read()


def cdc_apply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied_in_rounds(spark, sf_dir, "cdc_apply_stream", 3)


def resume_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the feed, a stop, and the rest by a new query on the same checkpoint."""
    return _applied_in_rounds(spark, sf_dir, "resume", 2)


def upsert_apply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of writes, of which the last comes first."""
    folder = scratch_dir(spark, "upsert_apply_stream")
    store = _base_store(spark, sf_dir, folder, VersionedStore)
    feed = fx.upserts(spark, sf_dir)

    def run() -> None:
        stream = feeds.file_feed(spark, f"{folder}/feed", feed.schema)
        start_upserts(stream, store, f"{folder}/cp", None).awaitTermination()

    _in_rounds(feed, "seq", 3, f"{folder}/feed", run, turns=(2, 0, 1))
    return store.read()


def resequenced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records arriving in three rounds of scattered offsets, then a record that only moves time."""
    folder = scratch_dir(spark, "resequence_stream")
    records = fx.gapped_records(spark, sf_dir).select(
        "topic",
        "partition",
        "offset",
        codecs.text(F.col("value")).alias("value"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset") % 3).alias("arrival"),
    )
    last = spark.range(1).select(
        F.lit("").alias("topic"),
        F.lit(-1).alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"),
        F.lit(None).cast("string").alias("value"),
        F.timestamp_seconds(F.lit(1_700_086_400)).alias("arrival"),
    )

    def run() -> None:
        stream = feeds.file_feed(spark, f"{folder}/feed", records.schema)
        start_resequence(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()

    for turn in range(3):
        part = records.where(F.col("offset") % 3 == turn)
        part.write.mode("append").parquet(f"{folder}/feed")
        run()
    last.write.mode("append").parquet(f"{folder}/feed")
    run()
    return released(spark, f"{folder}/out")


# Jobs


def job_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job_changelog")
    _write_feed(fx.envelope_records(spark, sf_dir), "offset", f"{folder}/feed")
    feed = feeds.file_feed(spark, f"{folder}/feed")
    jobs.changelog_job(feed, f"{folder}/out", f"{folder}/cp").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def job_jdbc_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job_jdbc_to_parquet")
    url, query = _base_in_database(spark, sf_dir)
    jobs.jdbc_to_parquet_job(spark, url, query, folder, split_by="id")
    return spark.read.parquet(folder)


def job_image_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job_image_log")
    _write_feed(fx.envelope_records(spark, sf_dir), "offset", f"{folder}/feed")
    feed = feeds.file_feed(spark, f"{folder}/feed")
    jobs.image_log_job(
        feed, f"{folder}/out", f"{folder}/cp", F.col("timestamp")
    ).awaitTermination()
    lines = spark.read.text(f"{folder}/out")
    bucket = F.col("bucket").cast("string").alias("bucket")
    return lines.select(F.col("value").alias("line"), bucket)


def job_cdc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job_cdc_upsert")
    store = _base_store(spark, sf_dir, folder, VersionedStore)
    feed = fx.envelope_records(spark, sf_dir)

    def run() -> None:
        records = feeds.file_feed(spark, f"{folder}/feed")
        jobs.keyed_topic_job(records, f"{folder}/topic", f"{folder}/cp_topic").awaitTermination()
        topic = feeds.file_feed(spark, f"{folder}/topic", jobs.TOPIC_SCHEMA)
        jobs.cdc_upsert_job(topic, store, f"{folder}/cp_store").awaitTermination()

    _in_rounds(feed, "offset", 2, f"{folder}/feed", run)
    return store.read()


class _LiveTable:
    """The base table as its feed changes it: ``now`` is how far it has come."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base, self.changes = fx.demo_base(spark, sf_dir), fx.changes(spark, sf_dir)
        self.now, self.end = self.changes.agg(F.min("seq") - 1, F.max("seq")).first()

    def rows(self, condition) -> DataFrame:
        state = apply.apply_changes(self.base, self.changes.where(F.col("seq") <= self.now), KEYS)
        return state if condition is None else state.where(condition)

    def position(self) -> int:
        # time goes on: the table is ahead of what the feed has delivered
        position, self.now = self.now, min(self.end, self.now + (self.end - self.now) // 3)
        return position


def job_initial_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of a table that changes while its chunks are read, over three stops."""
    folder = scratch_dir(spark, "job_initial_stream")
    live = _LiveTable(spark, sf_dir)
    source = SnapshotSource("id", live.rows, live.position)
    chunk_rows = live.base.count() // 4 + 1
    store = KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, buckets=8)
    feed = fx.envelope_records(spark, sf_dir)

    tops = iter(fx.cut_points(feed, "offset", 3)[1:])

    def run() -> None:
        # the table has taken whatever its feed delivers
        live.now = max(live.now, min(live.end, next(tops)))
        records = feeds.file_feed(spark, f"{folder}/feed")
        query, _ = jobs.initial_stream_job(records, source, store, f"{folder}/cp", chunk_rows)
        query.awaitTermination()

    _in_rounds(feed, "offset", 3, f"{folder}/feed", run)
    snapshot = Snapshot(store, source, plan_of(store, source, chunk_rows))
    snapshot.finish()
    finish_changes(store)
    if not snapshot.is_consistent():
        raise RuntimeError("the feed has ended before it passed the snapshot")
    return store.read()


def job_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "job_partitioned")
    image = T.StructType([*schemas.DEMO.fields, T.StructField("create_time", T.StringType())])
    row = F.struct(*image.names)
    topic_feed = fx.demo_timed(spark, sf_dir).select(
        codecs.to_json(F.struct("id")).alias("key"),
        codecs.to_json(row).alias("value"),
        F.col("seq").alias("offset"),
    )
    table, location = _timed_table(spark, "job_partitioned")
    committer = PartitionCommitter(spark, table, location, f"{folder}/state")
    seen = KeyedStore(spark, f"{folder}/seen", image, KEYS, buckets=8, key_filters=True)

    def run() -> None:
        topic = feeds.file_feed(spark, f"{folder}/topic", jobs.TOPIC_SCHEMA)
        jobs.partitioned_table_job(topic, image, seen, committer, f"{folder}/cp").awaitTermination()

    _in_rounds(topic_feed, "offset", 2, f"{folder}/topic", run)
    return spark.table(table)


def job_lines_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in two rounds; each adds its own to the table."""
    folder = scratch_dir(spark, "job_lines")
    table = _name("lines")
    tables.create_table(spark, table, schemas.LINE, f"{folder}/table")
    base = fx.demo_base(spark, sf_dir)
    for rest in range(2):
        lines = base.where(F.col("id") % 4 == 2 * rest).select(F.concat_ws(",", *COLUMNS).alias("value"))
        lines.write.mode("append").text(f"{folder}/lines")
        feed = feeds.line_feed(spark, f"{folder}/lines")
        jobs.lines_to_table_job(feed, table, f"{folder}/table", f"{folder}/cp")
    return spark.table(table)


def job_jdbc_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, table = _database(spark), _name("customers")
    customers = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.concat(F.lit("from database "), "c_name").alias("actor"),
        F.col("c_mktsegment").alias("alias"),
    )
    jdbc.write_table(customers, url, table)
    query = f'select "id", "actor", "alias" from {table}'
    base = fx.demo_base(spark, sf_dir)
    return jobs.jdbc_insert_if_absent_job(spark, url, query, base, split_by="id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        jdbc_scan,
        jdbc_scan_json,
        jdbc_scan_skewed,
        cdc_feed,
        start_earliest,
        start_after_offset,
        start_initial,
        kafka_json_decode,
        upsert_kafka_table,
        upsert_kafka_changelog,
        envelope_decode,
        envelope_decode_variant,
        raw_string_decode,
        delimited_lines,
        inline_rows,
        op_name,
        row_kind_op,
        projection,
        changelog_stream,
        retract_stream,
        null_record_filter,
        changelog_flatten,
        typed_record,
        resequence,
        row_to_text,
        partition_columns,
        widen_cast,
        upsert_kafka_encode,
        snapshot_diff,
        cdc_apply,
        cdc_apply_stream,
        insert_if_absent,
        delete_by_key,
        upsert_apply,
        upsert_apply_deletes,
        upsert_apply_stream,
        update_by_key,
        rolling_text_sink,
        rolling_text_pack,
        parquet_sink,
        partitioned_insert,
        append_only_guard,
        partition_commit,
        partition_commit_feeds,
        insert_select,
        insert_overwrite,
        text_append,
        drop_partition,
        sql_script,
        resume_exactly_once,
        job_changelog,
        job_jdbc_to_parquet,
        job_image_log,
        job_cdc_upsert,
        job_initial_stream,
        job_partitioned_table,
        job_lines_to_table,
        job_jdbc_insert_if_absent,
    )
}
QUERIES["resequence_stream"] = resequenced_stream
