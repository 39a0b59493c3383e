"""Order across micro-batches: versioned upserts, the feed's frontier, chunked snapshots."""

import itertools
import random

import pytest
from folds import fold_changes, fold_upserts
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_apply import BASE, CHANGES, UPSERTS, as_table, base, frame, random_changes, row

from tidelog import schemas, storage
from tidelog.operators import apply
from tidelog.sinks.store import KeyedStore, VersionedStore
from tidelog.sources import feeds
from tidelog.streaming.apply import finish_changes, start_apply_changes, start_upserts
from tidelog.streaming.snapshot import Snapshot, SnapshotSource, plan_chunks, plan_of

KEYS = ["id"]
LANED = f"{CHANGES}, lane int"


def versioned(spark, folder, rows=None, **options):
    options.setdefault("min_merge_rows", 0)
    store = VersionedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, 4, **options)
    store.create(base(spark, rows))
    return store


def writes(seed, n=60, ids=8):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        key = rng.randrange(ids)
        out.append((seq, key, None if rng.random() < 0.3 else row(key, f"a{seq}", rng.choice([None, "b"]))))
    return out


# Versioned upserts


@pytest.mark.parametrize("few_keys, merge_share, seed", [(0, 0.1, 1), (100, 0.1, 2), (100, 1000, 3)])
def test_writes_commute(spark, folder, monkeypatch, few_keys, merge_share, seed):
    """Any order and split of the writes gives the fold of them in order."""
    monkeypatch.setattr("tidelog.sinks.store.FEW_KEYS", few_keys)
    all_writes = writes(seed)
    want = fold_upserts(BASE, [w[1:] for w in all_writes])
    rng = random.Random(seed)
    store = versioned(spark, folder, merge_share=merge_share, max_deltas=2)
    rng.shuffle(all_writes)
    cuts = [0, *sorted(rng.sample(range(1, 60), 4)), 60]
    for low, high in itertools.pairwise(cuts):
        part = frame(spark, all_writes[low:high], UPSERTS)
        store.commit(apply.latest_versions(part, KEYS, deletes=True))
    assert as_table(store.read()) == want
    # a write that comes again changes nothing
    store.commit(apply.latest_versions(frame(spark, all_writes[:9], UPSERTS), KEYS, deletes=True))
    assert as_table(store.read()) == want


def test_stale_write_loses(spark, folder):
    store = versioned(spark, folder, {})
    schema = T.StructType.fromDDL(UPSERTS)
    sent = [(10, 1, row(1, "new")), (2, 1, row(1, "old")), (12, 2, None), (3, 2, row(2, "gone")), (11, 3, row(3, "x"))]
    for i, write in enumerate(sent):
        frame(spark, [write], UPSERTS).write.mode("append").parquet(f"{folder}/feed")
        stream = feeds.file_feed(spark, f"{folder}/feed", schema, maxFilesPerTrigger="1")
        start_upserts(stream, store, f"{folder}/cp", None, deletes=True).awaitTermination()
    assert as_table(store.read()) == {1: row(1, "new"), 3: row(3, "x")}


def test_upserts_need_a_versioned_store(spark, folder):
    plain = KeyedStore(spark, f"{folder}/plain", schemas.DEMO, KEYS, 2)
    stream = feeds.file_feed(spark, folder, T.StructType.fromDDL(UPSERTS))
    with pytest.raises(TypeError, match="VersionedStore"):
        start_upserts(stream, plain, f"{folder}/cp")
    store = versioned(spark, folder)
    with pytest.raises(TypeError, match="takes upserts"):
        start_apply_changes(stream, store, f"{folder}/cp")
    with pytest.raises(ValueError, match="laid out as"):
        KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, 4).read()


def test_forgotten_deletes(spark, folder):
    """Old tombstones go; a write that may be older than one of them fails, others do not."""
    store = versioned(spark, folder, {}, retain=5)

    def send(*rows):
        store.commit(apply.latest_versions(frame(spark, rows, UPSERTS), KEYS, deletes=True))
        return as_table(store.read())

    assert send((1, 1, row(1, "a")), (2, 1, None), (3, 2, row(2, "b"))) == {2: row(2, "b")}
    assert store._base(store.manifest().buckets).count() == 2
    # every bucket is rewritten, and 1's tombstone lies more than five positions behind
    got = send(*[(20 + k, k, row(k, "n")) for k in range(3, 30)])
    assert 1 not in got and store._base(store.manifest().buckets).where("_deleted").count() == 0
    assert store.manifest().horizon == 20 + 29 - 5
    assert send((4, 2, row(2, "c")))[2] == row(2, "c")
    assert send((1, 2, row(2, "older")))[2] == row(2, "c")
    with pytest.raises(ValueError, match="deletes were forgotten"):
        send((1, 1, row(1, "a")))
    assert 1 not in as_table(store.read())


def test_write_without_seq_fails(spark):
    with pytest.raises(Exception, match="without seq"):
        apply.latest_versions(frame(spark, [(None, 1, row(1))], UPSERTS), KEYS).collect()
    with pytest.raises(Exception, match="without deletes"):
        apply.latest_versions(frame(spark, [(1, 1, None)], UPSERTS), KEYS).collect()


def test_versions_are_vacuumed(spark, folder):
    store = versioned(spark, folder, {}, merge_share=1000, min_merge_rows=1_000, keep_versions=8, max_deltas=3)
    for seq in range(20):
        part = frame(spark, [(seq, seq % 3, row(seq % 3, f"a{seq}"))], UPSERTS)
        store.commit(apply.latest_versions(part, KEYS), "feed", seq)
    assert len(storage.list_names(spark, f"{folder}/store/manifest")) <= 16
    assert as_table(store.read()) == {k: row(k, f"a{max(s for s in range(20) if s % 3 == k)}") for k in range(3)}


# The frontier


def laned(seed, n=200, lanes=3):
    """Changes with a lane; and every lane's, in order."""
    rng = random.Random(seed)
    changes = [(*c, rng.randrange(lanes)) for c in random_changes(seed, n=n)]
    return changes, [[c for c in changes if c[4] == lane] for lane in range(lanes)]


def send(spark, folder, store, rows, checkpoint="cp", **options):
    frame(spark, rows, LANED).coalesce(1).write.mode("append").parquet(f"{folder}/feed-{checkpoint}")
    schema = T.StructType.fromDDL(LANED)
    stream = feeds.file_feed(spark, f"{folder}/feed-{checkpoint}", schema)
    start_apply_changes(
        stream, store, f"{folder}/{checkpoint}", None, ["lane"], **options
    ).awaitTermination()


def plain(spark, folder):
    store = KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, 4, min_merge_rows=0)
    store.create(base(spark))
    return store


@pytest.mark.parametrize("seed", [3])
def test_lanes_run_ahead_of_each_other(spark, folder, seed):
    """Each lane in order, the lanes at their own pace: the table is the fold up to the frontier."""
    changes, lanes = laned(seed)
    store, rng = plain(spark, folder), random.Random(seed)
    at = [0] * len(lanes)
    while any(i < len(lane) for i, lane in zip(at, lanes)):
        batch = []
        for k, lane in enumerate(lanes):
            step = rng.randint(0, 60)
            batch += lane[at[k] : at[k] + step]
            at[k] += step
        if not batch:
            continue
        send(spark, folder, store, batch, expected_lanes=3)
        applied = store.manifest().applied
        done = [] if applied is None else [c for c in changes if c[0] <= applied]
        assert as_table(store.read()) == fold_changes(BASE, [c[1:4] for c in done])
    finish_changes(store)
    assert as_table(store.read()) == fold_changes(BASE, [c[1:4] for c in changes])
    assert store.read_held() is None
    finish_changes(store)


def test_slack_puts_shuffled_batches_right(spark, folder):
    changes, _ = laned(5, n=120)
    blocks = [changes[i : i + 20] for i in range(0, 120, 20)]
    store = plain(spark, folder)
    for i in (1, 0, 3, 2, 5, 4):
        send(spark, folder, store, blocks[i], slack=40)
    finish_changes(store)
    assert as_table(store.read()) == fold_changes(BASE, [c[1:4] for c in changes])


def test_out_of_order_fails_by_name(spark, folder):
    """A delete at 10, then a create at 2: not applied, not passed over."""
    store = plain(spark, folder)
    send(spark, folder, store, [(10, "d", row(0), None, 1)])
    before = store.manifest().version
    with pytest.raises(Exception, match="out of order.*delivers 2"):
        send(spark, folder, store, [(2, "c", None, row(0, "back"), 1)])
    assert store.manifest().version == before and 0 not in as_table(store.read())
    with pytest.raises(Exception, match="without seq"):
        send(spark, folder, store, [(None, "c", None, row(0), 1)], "other")


def test_feed_from_the_start_is_passed_over(spark, folder):
    changes, _ = laned(6, n=60)
    store = plain(spark, folder)
    send(spark, folder, store, changes[:40])
    want = as_table(store.read())
    with pytest.raises(Exception, match="out of order"):
        send(spark, folder, store, changes[:20], "again")
    send(spark, folder, store, changes[:20], "skipping", late="skip")
    send(spark, folder, store, changes[20:], "skipping", late="skip")
    finish_changes(store)
    assert as_table(store.read()) == fold_changes(BASE, [c[1:4] for c in changes]) != want


def test_a_silent_lane_is_not_waited_for(spark, folder):
    store = plain(spark, folder)
    lane = lambda seq, key, number: (seq, "c", None, row(key, f"s{seq}"), number)
    send(spark, folder, store, [lane(1, 101, 0), lane(2, 102, 1)], idle_after=1)
    send(spark, folder, store, [lane(5, 105, 1)], idle_after=1)
    assert store.manifest().applied == 1 and 105 not in as_table(store.read())
    send(spark, folder, store, [lane(6, 106, 1)], idle_after=1)
    assert store.manifest().applied == 6 and {105, 106} <= set(as_table(store.read()))
    with pytest.raises(Exception, match="out of order"):
        send(spark, folder, store, [lane(3, 103, 0)], idle_after=1)


def test_what_waits_is_bounded(spark, folder):
    changes, lanes = laned(7, n=60, lanes=2)
    store = plain(spark, folder)
    with pytest.raises(Exception, match="changes wait for lane"):
        send(spark, folder, store, lanes[0] + lanes[1][:1], expected_lanes=2, max_held=3)


def test_crash_between_batches_loses_nothing_that_waits(spark, folder):
    changes, lanes = laned(8, n=60, lanes=2)
    store = plain(spark, folder)
    send(spark, folder, store, lanes[0][:20] + lanes[1][:3], expected_lanes=2)
    send(spark, folder, store, lanes[0][20:], expected_lanes=2)
    held = store.read_held().count()
    # the table was published, the checkpoint was not: the last batch comes again
    for name in ("1", ".1.crc"):
        storage.delete_folder(spark, f"{folder}/cp/commits/{name}")
    send(spark, folder, store, lanes[1][3:], expected_lanes=2)
    assert held > 0
    finish_changes(store)
    assert as_table(store.read()) == fold_changes(BASE, [c[1:4] for c in changes])


# Snapshots


class Live:
    """A table that its feed changes; every read and question lets time go on."""

    def __init__(self, spark, changes, pace):
        self.spark, self.changes, self.pace, self.now, self.reads = spark, changes, pace, 0, 0
        self.fail_at = None

    def state(self):
        return fold_changes(BASE, [c[1:4] for c in self.changes if c[0] < self.now])

    def rows(self, condition):
        self.reads += 1
        if self.fail_at is not None and self.reads > self.fail_at:
            raise ConnectionError("the source went away")
        self.now += self.pace
        df = base(self.spark, self.state())
        return df if condition is None else df.where(condition)

    def position(self):
        self.now += self.pace
        return min(self.now, len(self.changes)) - 1

    def source(self):
        return SnapshotSource("id", self.rows, self.position)


def copy_job(spark, folder, live, store, rows, chunk_rows=2, **options):
    live.now = max(live.now, max((r[0] for r in rows), default=0) + 1)
    snapshot = Snapshot(store, live.source(), plan_of(store, live.source(), chunk_rows))
    send(spark, folder, store, rows, snapshot=snapshot, **options)
    return snapshot


@pytest.mark.parametrize("pace, fail_at", [(0, None), (7, 0), (40, 1), (7, 2), (40, 4)])
def test_snapshot_then_follow(spark, folder, pace, fail_at):
    """Chunks at different positions, and a stop after any of them."""
    changes, _ = laned(9, n=160, lanes=1)
    live = Live(spark, changes, pace)
    store = KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, 4, min_merge_rows=0)
    plan = plan_of(store, live.source(), 2)
    assert len(plan) >= 2
    if fail_at is not None:
        live.fail_at = live.reads + fail_at
    for low in range(0, 160, 40):
        try:
            snapshot = copy_job(spark, folder, live, store, changes[low : low + 40])
        except Exception as error:
            assert "the source went away" in str(error)
            live.fail_at = None
            snapshot = copy_job(spark, folder, live, store, [])
    live.fail_at = None
    live.now = 160
    snapshot.finish()
    assert snapshot.is_complete()
    finish_changes(store)
    assert snapshot.is_consistent()
    assert as_table(store.read()) == fold_changes(BASE, [c[1:4] for c in changes])


def test_plan_is_near_equal_in_rows(spark):
    """90 of 100 keys lie in a hundredth of the range."""
    ids = [*range(900), *range(10_000, 90_000, 800)]
    table = spark.createDataFrame([(i,) for i in ids], "id int")
    source = SnapshotSource("id", lambda c: table if c is None else table.where(c), lambda: 0)
    bounds = [-1, *plan_chunks(source, 100), 10**6]
    sizes = [table.where((F.col("id") > a) & (F.col("id") <= b)).count() for a, b in itertools.pairwise(bounds)]
    assert len(sizes) == 10 and max(sizes) <= 200 and sum(sizes) == 1_000
    assert plan_chunks(SnapshotSource("id", lambda c: table.where("id < 0"), lambda: 0), 10) == []


# Key filters


def test_only_buckets_that_may_hold_a_key_are_read(spark, folder, monkeypatch):
    rows = {k: row(k, "base") for k in range(0, 4_000, 2)}
    store = KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, 64, merge_share=0, min_merge_rows=0, key_filters=True)
    store.create(base(spark, rows))
    assert len(store.manifest().buckets) == 64
    ids = lambda keys: spark.createDataFrame([(k,) for k in keys], "id int")
    bucket = {r.id: r.b for r in base(spark, rows).select("id", store._bucket().alias("b")).collect()}
    # a key that is there is never missed; keys that are not there touch few of the 64
    for key in (0, 778, 3_998):
        assert bucket[key] in store.may_hold(ids([key]))
    absent = store.may_hold(ids(range(1, 400, 2)))
    assert len(absent) < 20
    assert store.may_hold(ids(range(0, 4_000, 2))) == set(range(64))
    assert store.may_hold(ids([])) == set()
    # a changed bucket gets a new filter, and rows come back through it
    change = [(1, "c", None, row(1, "new")), (2, "d", row(2), None), (3, "c", None, row(2, "again"))]
    store.commit(apply.reduce_changes(frame(spark, change, CHANGES), KEYS), "feed", 0)
    assert len(set(store.manifest().buckets.values())) == 2
    read = []
    inner = KeyedStore._base

    def counted(self, buckets):
        read.append(set(buckets))
        return inner(self, buckets)

    monkeypatch.setattr(KeyedStore, "_base", counted)
    got = as_table(store.read_matching(ids([1, 2]), "feed", 1))
    assert got[1] == row(1, "new") and got[2] == row(2, "again") and len(read[-1]) <= 4
    assert 1 not in as_table(store.read_matching(ids([1, 2]), "feed", 0))
    store.vacuum(keep=1)
    assert as_table(store.read_matching(ids([1]), "feed", 1))[1] == row(1, "new")


def test_without_filters_buckets_of_the_keys_are_read(spark, folder):
    store = KeyedStore(spark, f"{folder}/store", schemas.DEMO, KEYS, 64, min_merge_rows=0)
    store.create(base(spark, {k: row(k) for k in range(500)}))
    assert len(store.may_hold(spark.createDataFrame([(3,), (4,)], "id int"))) <= 2
