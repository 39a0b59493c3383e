import random
from dataclasses import replace

import pytest
from folds import fold_changes
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_apply import BASE, CHANGES, as_table, base, frame, random_changes

from tidelog import schemas, storage
from tidelog.functions import codecs
from tidelog.operators import apply
from tidelog.plans import jobs
from tidelog.sinks import files, tables
from tidelog.sinks.store import KeyedStore
from tidelog.sources import feeds
from tidelog.streaming.apply import start_apply_changes
from tidelog.streaming.commit import PARTS, PartitionCommitter, start_partition_commit
from tidelog.streaming.resequence import released, start_resequence

KEYS = ["id"]


def new_store(spark, folder, buckets=4, **options):
    options.setdefault("min_merge_rows", 0)
    store = KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, buckets, **options)
    store.create(base(spark))
    return store


def run_stream(spark, folder, store, schema):
    stream = feeds.file_feed(spark, f"{folder}/feed", schema)
    start_apply_changes(stream, store, f"{folder}/cp", None).awaitTermination()


@pytest.mark.parametrize("merge_share", [0.1, 1000])
def test_stream_equals_fold_and_replay_is_harmless(spark, folder, merge_share):
    changes = random_changes(11, n=300)
    store = new_store(spark, folder, merge_share=merge_share)
    rng = random.Random(1)
    cuts = [0, *sorted(rng.sample(range(1, 300), 2)), 300]
    schema = T.StructType.fromDDL(CHANGES)
    for low, high in zip(cuts, cuts[1:]):
        frame(spark, changes[low:high], schema).write.mode("append").parquet(f"{folder}/feed")
        run_stream(spark, folder, store, schema)
    want = fold_changes(BASE, [c[1:] for c in changes])
    assert as_table(store.read()) == want
    version = store.manifest().version
    # A crash after the commit but before the checkpoint: the last batch comes again.
    storage.delete_folder(spark, f"{folder}/cp/commits/2")
    storage.delete_folder(spark, f"{folder}/cp/commits/.2.crc")
    run_stream(spark, folder, store, schema)
    assert as_table(store.read()) == want
    assert store.manifest().version == version


def test_half_written_commit_is_ignored(spark, folder):
    store = new_store(spark, folder)
    reduced = apply.reduce_changes(frame(spark, random_changes(2), CHANGES), KEYS)
    base(spark, {}).write.parquet(f"{folder}/store/delta/v=2")
    base(spark, {}).write.parquet(f"{folder}/store/base/v=3/bucket=0")
    assert as_table(store.read()) == BASE
    store.commit(reduced, "feed", 0)
    want = fold_changes(BASE, [c[1:] for c in random_changes(2)])
    assert as_table(store.read()) == want
    store.commit(reduced, "feed", 0)
    assert store.manifest().version == 3 and not store.manifest().deltas
    assert as_table(store.read_before("feed", 0)) == BASE
    assert as_table(store.read_before("feed", 1)) == want


def test_large_merge_writes_one_file_per_bucket(spark, folder, monkeypatch):
    monkeypatch.setattr("tidelog.sinks.store.FEW_KEYS", 0)
    store = new_store(spark, folder)
    changes = random_changes(8)
    store.commit(apply.reduce_changes(frame(spark, changes, CHANGES), KEYS))
    assert as_table(store.read()) == fold_changes(BASE, [c[1:] for c in changes])
    for bucket, version in store.manifest().buckets.items():
        parts = storage.list_names(spark, f"{folder}/store/base/v={version}/bucket={bucket}")
        assert len([p for p in parts if p.endswith(".parquet")]) == 1


@pytest.mark.parametrize("few_keys", [0, 100])
def test_deltas_combine_and_merge(spark, folder, monkeypatch, few_keys):
    monkeypatch.setattr("tidelog.sinks.store.FEW_KEYS", few_keys)
    store = new_store(spark, folder, buckets=16, merge_share=1000, max_deltas=3)
    changes = random_changes(13, n=100, ids=30)
    for batch, low in enumerate(range(0, 100, 20)):
        reduced = apply.reduce_changes(frame(spark, changes[low : low + 20], CHANGES), KEYS)
        store.commit(reduced, "feed", batch)
        want = fold_changes(BASE, [c[1:] for c in changes[: low + 20]])
        assert as_table(store.read()) == want
    assert len(store.manifest().deltas) == 2
    store.vacuum(keep=1)
    assert as_table(store.read()) == want
    store.merge_deltas()
    assert as_table(store.read()) == want
    assert store.manifest().base_rows == len(want) and not store.manifest().deltas
    store.vacuum(keep=1)
    assert as_table(store.read()) == want
    assert storage.list_names(spark, f"{folder}/store/delta") == []


def test_untouched_buckets_stay(spark, folder):
    store = new_store(spark, folder, buckets=16)
    change = [(1, "c", None, {"id": 1, "actor": "n", "alias": None})]
    store.commit(apply.reduce_changes(frame(spark, change, CHANGES), KEYS))
    assert set(store.manifest().buckets.values()) == {1, 3}
    assert len(as_table(store.read())) == len(BASE) + 1


def test_store_can_become_empty(spark, folder):
    store = new_store(spark, folder)
    drops = [(i, "d", {"id": k, "actor": None, "alias": None}, None) for i, k in enumerate(BASE)]
    store.commit(apply.reduce_changes(frame(spark, drops, CHANGES), KEYS))
    assert store.read().count() == 0 and store.manifest().buckets == {}
    assert store.manifest().base_rows == 0


def arrive(spark, folder, rows, width=1 << 20, **options):
    """Rows of (partition, offset, value, arrival second) as one round of the stream."""
    schema = "partition int, offset bigint, value string, second bigint"
    df = spark.createDataFrame(rows, schema).select(
        F.lit("t").alias("topic"),
        "partition",
        "offset",
        "value",
        F.timestamp_seconds(F.col("second") + 1_700_000_000).alias("arrival"),
    )
    df.write.mode("append").parquet(f"{folder}/feed")
    stream = feeds.file_feed(spark, f"{folder}/feed", df.schema)
    query = start_resequence(stream, f"{folder}/out", f"{folder}/cp", max_wait="60 seconds", width=width, **options)
    query.awaitTermination()
    return sorted(tuple(r)[1:] for r in released(spark, f"{folder}/out").collect())


@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_resequence_stream(spark, folder, width):
    got = arrive(spark, folder, [(0, 1, "b", 0), (0, 0, "a", 0), (0, 3, "d", 0)], width)
    assert got == [(0, 0, "a", 0, False), (0, 1, "b", 0, False)]
    # The gap closes for partition 0; copies of released records are dropped.
    got = arrive(spark, folder, [(0, 2, "c", 10), (0, 0, "a", 10), (1, 9, "z", 10)], width)
    assert got == [(0, i, v, 0, False) for i, v in enumerate("abcd")]
    # Arrival time moves on: partition 1 stops waiting for the offsets before 9.
    got = arrive(spark, folder, [(-1, -1, None, 200)], width)
    assert (1, 9, "z", 9, False) in got and len(got) == 5
    # Two of them turn up after all, once. What follows 6 waits, at any width.
    late = [(1, 6, "y", 210), (1, 6, "y", 210), (1, 10, "w", 210), (1, 0, "v", 210), (1, 14, "u", 210)]
    got = arrive(spark, folder, late, width)
    assert {(1, 6, "y", 0, True), (1, 0, "v", 0, True), (1, 10, "w", 0, False)} < set(got) and len(got) == 8
    got = arrive(spark, folder, [(1, 6, "y", 220), (1, 7, "x", 220), (1, 15, "s", 220)], width)
    assert (1, 7, "x", 0, True) in got and len(got) == 9
    # 14 has waited, and 15 follows it: 11, 12 and 13 are given up.
    got = arrive(spark, folder, [(1, 30, "r", 275)], width)
    assert {(1, 14, "u", 3, False), (1, 15, "s", 0, False)} < set(got) and len(got) == 11
    assert len(storage.list_names(spark, f"{folder}/cp/held")) == 2


def test_given_up_ranges_are_few_and_forgotten(spark, folder):
    """A range shrinks with late records, splits in two at most, and goes when it is old."""

    def ranges():
        number = max(int(n) for n in storage.list_names(spark, f"{folder}/cp/held"))
        path = f"{folder}/cp/held/{number}/gaps"
        if not storage.exists(spark, path):
            return []
        return sorted((r.low, r.high) for r in spark.read.parquet(path).collect())

    def send(rows):
        return arrive(spark, folder, rows, forget_after="10 minutes")

    send([(0, 100, "a", 0)])
    got = send([(-1, -1, None, 100)])
    assert got == [(0, 100, "a", 100, False)] and ranges() == [(0, 99)]
    send([(0, 99, "b", 110), (0, 0, "c", 110), (0, 50, "d", 110)])
    assert ranges() == [(1, 49), (51, 98)]
    got = send([(0, 101, "e", 300), (0, 50, "copy", 300), (0, 7, "f", 300)])
    assert len(got) == 6 and ranges() == [(1, 6), (8, 49), (51, 98)]
    # eleven minutes after they were given up
    send([(0, 102, "g", 800), (0, 60, "forgotten", 800)])
    assert ranges() == []
    got = send([(0, 61, "forgotten", 801), (0, 103, "h", 801)])
    assert [r[2] for r in got] == ["c", "f", "d", "forgotten", "b", "a", "e", "g", "h"]


def test_resequence_keeps_a_lagging_partition(spark, folder):
    arrive(spark, folder, [(0, 0, "a", 1000)])
    got = arrive(spark, folder, [(1, 0, "b", 100), (1, 1, "c", 101), (1, 3, "d", 102)])
    assert got == [(0, 0, "a", 0, False), (1, 0, "b", 0, False), (1, 1, "c", 0, False)]
    got = arrive(spark, folder, [(1, 2, "e", 103)])
    assert got[3:] == [(1, 2, "e", 0, False), (1, 3, "d", 0, False)]


def timed(spark, rows):
    """Rows of (id, hour, minute of event) as committer input."""
    df = spark.createDataFrame(rows, "id bigint, hour int, minute int")
    ts = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), "hour", "minute", F.lit(0))
    text = F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH:mm:ss")
    return df.select("id", ts.alias("event_time"), *codecs.partition_columns(text))


def test_partition_commit(spark, folder):
    schema = T.StructType.fromDDL("id bigint, ts_date string, ts_hour string, ts_minute string")
    tables.create_table(spark, "committed", schema, f"{folder}/table", PARTS)
    table, state = f"{folder}/table", f"{folder}/state"
    committer = PartitionCommitter(spark, "committed", table, state, "5 minutes")
    ids = lambda: sorted(r.id for r in spark.table("committed").select("id").collect())
    committer.process(timed(spark, [(1, 1, 0), (2, 1, 30), (3, 2, 5)]), "event_time", 0)
    assert ids() == [1, 2]
    assert storage.exists(spark, f"{table}/ts_date=20240101/ts_hour=01/ts_minute=00/_SUCCESS")
    committer.process(timed(spark, [(4, 2, 10)]), "event_time", 1)
    assert ids() == [1, 2, 3, 4]
    # A late row publishes its partition again, whole; a replay of the batch changes nothing.
    for _ in range(2):
        committer.process(timed(spark, [(5, 1, 59), (6, 3, 0)]), "event_time", 2)
        assert ids() == [1, 2, 3, 4, 5]
    ledger = {r.ts_hour: (r.published_in, r.late) for r in committer.published().collect()}
    assert ledger["01"] == (2, True) and ledger["02"][0] == 1 and not ledger["02"][1]
    # The ledger remembers what was late; a row without a partition fails its batch.
    committer.process(timed(spark, [(7, 4, 0)]), "event_time", 3)
    assert {r.ts_hour: r.late for r in committer.ledger().collect()}["01"] is True
    nowhere = timed(spark, [(8, 4, 1)]).withColumn("ts_hour", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="a row without ts_hour"):
        committer.process(nowhere, "event_time", 4)


def test_partition_commit_on_a_new_checkpoint(spark, folder):
    """A second feed reuses batch number 0 and takes nothing from the first."""
    schema = T.StructType.fromDDL("id bigint, ts_date string, ts_hour string, ts_minute string")
    tables.create_table(spark, "two_feeds", schema, f"{folder}/table", PARTS)
    committer = PartitionCommitter(spark, "two_feeds", f"{folder}/table", f"{folder}/state")

    def send(checkpoint, *rows):
        timed(spark, rows).write.mode("append").parquet(f"{folder}/{checkpoint}-in")
        kind = spark.read.parquet(f"{folder}/{checkpoint}-in").schema
        stream = feeds.file_feed(spark, f"{folder}/{checkpoint}-in", kind)
        path = f"{folder}/{checkpoint}"
        start_partition_commit(stream, committer, "event_time", path, None).awaitTermination()
        return sorted(r.id for r in spark.table("two_feeds").select("id").collect())

    assert send("a", (1, 1, 0), (2, 1, 30), (3, 2, 5), (4, 3, 0)) == [1, 2, 3]
    # one row late for hour 1, one that completes hour 3
    assert send("b", (9, 1, 10), (10, 4, 0)) == [1, 2, 3, 4, 9]
    assert {r.ts_hour: r.late for r in committer.published().collect()} == {
        "01": True, "02": False, "03": False
    }
    # the first feed goes on where it was
    assert send("a", (11, 5, 0)) == [1, 2, 3, 4, 9, 10]


def test_staging_shrinks_and_late_rows_survive_a_crash(spark, folder, monkeypatch):
    """Only open partitions stay staged; a late partition is replaced once, though its batch runs twice."""
    schema = T.StructType.fromDDL("id bigint, ts_date string, ts_hour string, ts_minute string")
    tables.create_table(spark, "swept", schema, f"{folder}/table", PARTS)
    committer = PartitionCommitter(spark, "swept", f"{folder}/table", f"{folder}/state")
    ids = lambda: sorted(r.id for r in spark.table("swept").select("id").collect())
    for n in range(5):
        committer.process(timed(spark, [(2 * n, n, 0), (2 * n + 1, n, 30)]), "event_time", n)
    # hour 4 is published too, but for its own batch nothing is open
    assert ids() == list(range(10))
    assert len(storage.list_names(spark, f"{folder}/state/stage")) <= 1
    assert len(storage.list_names(spark, f"{folder}/state/ledger")) == 1
    touch = storage.touch

    def crash(spark_, path):
        if "/done/" in path:
            raise OSError("died before its marker")
        touch(spark_, path)

    late = timed(spark, [(100, 1, 5), (101, 6, 0)])
    monkeypatch.setattr(storage, "touch", crash)
    with pytest.raises(OSError, match="died"):
        committer.process(late, "event_time", 5)
    monkeypatch.undo()
    committer.process(late, "event_time", 5)
    assert ids() == [*range(10), 100]
    assert storage.list_names(spark, f"{folder}/state/copies") == []
    assert len(storage.list_names(spark, f"{folder}/state/stage")) == 1


def test_partition_commit_of_several_feeds(spark, folder):
    """Event time is the slowest feed's; a feed that falls silent blocks no longer than it may."""
    schema = T.StructType.fromDDL("id bigint, ts_date string, ts_hour string, ts_minute string")
    tables.create_table(spark, "several_feeds", schema, f"{folder}/table", PARTS)
    committer = PartitionCommitter(
        spark, "several_feeds", f"{folder}/table", f"{folder}/state", "1 hour", feeds=("a", "b"), idle_after=2
    )
    sent = {"a": 0, "b": 0}

    def send(feed, *rows):
        committer.process(timed(spark, rows), "event_time", sent[feed], f"cp-{feed}", feed)
        sent[feed] += 1
        return sorted(r.id for r in spark.table("several_feeds").select("id").collect())

    # b has sent nothing yet, and may still send hour 1
    assert send("a", (1, 1, 0), (2, 3, 0)) == []
    assert send("b", (3, 1, 5), (4, 2, 10)) == [1, 3]
    # a runs ahead, b stays behind in hour 2
    assert send("a", (5, 6, 0)) == [1, 3]
    assert send("b", (6, 2, 30)) == [1, 3]
    # b is silent for more than two batches of a
    assert send("a", (7, 7, 0)) == [1, 3]
    assert send("a", (8, 8, 0)) == [1, 3]
    assert send("a", (9, 9, 0)) == [1, 2, 3, 4, 5, 6, 7]
    # it speaks again: its hour is published late, and it holds a back again
    assert send("b", (10, 2, 40)) == [1, 2, 3, 4, 5, 6, 7, 10]
    assert send("a", (11, 10, 0)) == [1, 2, 3, 4, 5, 6, 7, 10]
    assert send("b", (12, 9, 30)) == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert {r.ts_hour: r.late for r in committer.published().collect()}["02"] is True
    with pytest.raises(ValueError, match="none of the feeds"):
        committer.process(timed(spark, []), "event_time", 0, "cp", "c")


def test_store_refuses_another_layout(spark, folder):
    rows = spark.createDataFrame([(1, "a", "b")], schemas.DEMO)
    KeyedStore(spark, f"{folder}/s", schemas.DEMO, KEYS, 4).create(rows)
    assert KeyedStore(spark, f"{folder}/s", schemas.DEMO, KEYS, 4).read().count() == 1
    with pytest.raises(ValueError, match="laid out as"):
        KeyedStore(spark, f"{folder}/s", schemas.DEMO, KEYS, 8).read()


def test_second_writer_fails(spark, folder):
    rows = spark.createDataFrame([(1, "a", "b")], schemas.DEMO)
    store = KeyedStore(spark, f"{folder}/s", schemas.DEMO, KEYS, 4)
    store.create(rows)
    seen = store.manifest()
    reduced = rows.select("id", F.lit(True).alias("had_delete"), F.struct("*").alias("row"))
    store.commit(reduced, "feed", 0)
    with pytest.raises(OSError, match="could not publish"):
        store._publish(replace(seen, version=seen.version + 1))
    assert store.manifest().feeds == {"feed": 0}


def test_history_that_vacuum_took_is_not_an_empty_table(spark, folder):
    rows = spark.createDataFrame([(1, "a", "b")], schemas.DEMO)
    store = KeyedStore(spark, f"{folder}/s", schemas.DEMO, KEYS, 4)
    store.create(rows)
    changed = F.struct(F.col("id"), F.lit("z").alias("actor"), F.col("alias"))
    reduced = rows.select("id", F.lit(True).alias("had_delete"), changed.alias("row"))
    store.commit(reduced, "feed", 0)
    assert store.read_before("feed", 0).first().actor == "a"
    store.vacuum(keep=1)
    with pytest.raises(ValueError, match="no longer kept"):
        store.read_before("feed", 0)


def test_partitioned_table_job_refuses_updates(spark, folder):
    image = T.StructType([*schemas.DEMO.fields, T.StructField("create_time", T.StringType())])
    schema = T.StructType(
        [*schemas.DEMO_WIDE.fields, *[T.StructField(p, T.StringType()) for p in PARTS]]
    )
    tables.create_table(spark, "insert_only", schema, f"{folder}/table", PARTS)
    committer = PartitionCommitter(spark, "insert_only", f"{folder}/table", f"{folder}/state")
    seen = KeyedStore(spark, f"{folder}/seen", image, KEYS, 2)

    def send(key, offset):
        value = f'{{"id":{key},"actor":"a","alias":null,"create_time":"2024-01-01 0{offset}:00:00"}}'
        row = spark.createDataFrame([(f'{{"id":{key}}}', value, offset)], jobs.TOPIC_SCHEMA)
        row.write.mode("append").parquet(f"{folder}/topic")
        topic = feeds.file_feed(spark, f"{folder}/topic", jobs.TOPIC_SCHEMA)
        jobs.partitioned_table_job(topic, image, seen, committer, f"{folder}/cp").awaitTermination()

    send(1, 1)
    send(2, 2)
    assert [r.id for r in spark.table("insert_only").collect()] == [1]
    # A crash after everything was written: the replayed batch is not taken for updates.
    storage.delete_folder(spark, f"{folder}/cp/commits/1")
    storage.delete_folder(spark, f"{folder}/cp/commits/.1.crc")
    send(3, 3)
    assert sorted(r.id for r in spark.table("insert_only").collect()) == [1, 2]
    with pytest.raises(Exception, match="append-only"):
        send(1, 4)


def test_image_log_forms_agree(spark, folder):
    changes = [c for c in random_changes(9, n=60) if c[1] in "cudr"]
    df = frame(spark, changes, CHANGES).select(
        codecs.to_json(F.struct("before", "after", "op")).cast("binary").alias("value"),
        F.col("seq").alias("offset"),
        F.timestamp_seconds(F.col("seq") * 100).alias("timestamp"),
    )
    df.write.parquet(f"{folder}/feed")
    texts = {}
    for form in ("changelog", "retract"):
        stream = feeds.file_feed(spark, f"{folder}/feed", df.schema)
        query = jobs.image_log_job(
            stream, f"{folder}/{form}", f"{folder}/cp_{form}", F.col("timestamp"), form
        )
        query.awaitTermination()
        rows = spark.read.text(f"{folder}/{form}").collect()
        texts[form] = sorted(tuple(r) for r in rows)
    assert texts["changelog"] == texts["retract"]
    images = sum(2 if c[1] == "u" else 1 for c in changes)
    assert len(texts["changelog"]) == images
    assert all(v.startswith("Demo(id=") for v, _ in texts["changelog"])


def test_changelog_job_prints(spark, folder):
    changes = [c for c in random_changes(1, n=5) if c[1] in "cudr"]
    df = frame(spark, changes, CHANGES).select(
        codecs.to_json(F.struct("before", "after", "op")).cast("binary").alias("value"),
        F.col("seq").alias("offset"),
    )
    tombstone = spark.createDataFrame([(None, 99)], df.schema)
    df.unionByName(tombstone).write.parquet(f"{folder}/feed")
    stream = feeds.file_feed(spark, f"{folder}/feed", df.schema)
    query = jobs.changelog_job(stream, None, f"{folder}/cp")
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) >= len(changes)
