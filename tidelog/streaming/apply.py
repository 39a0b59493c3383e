"""Applying change streams to a keyed store, exactly once.

Changes go through the feed's frontier (``frontier``), so micro-batches may come in any order
that it can put right; a snapshot of the source can be taken meanwhile (``snapshot``). Upserts
go to a versioned store, where their order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog import storage
from tidelog.operators import apply as ops
from tidelog.sinks.store import KeyedStore, VersionedStore
from tidelog.streaming import frontier
from tidelog.streaming.snapshot import Snapshot


def _start(
    stream: DataFrame, commit: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()


def start_apply_changes(
    stream: DataFrame,
    store: KeyedStore,
    checkpoint: str,
    trigger: str | None = "5 seconds",
    lanes: Sequence[str] = (),
    slack: int = 0,
    expected_lanes: int | None = None,
    late: str = "fail",
    max_held: int = frontier.MAX_HELD,
    idle_after: int | None = None,
    snapshot: Snapshot | None = None,
    chunks_per_batch: int = 1,
    **options,
) -> StreamingQuery:
    """Apply a stream of changes (``seq, op, before, after``, and ``lanes``) in order of ``seq``.

    Without ``lanes`` the feed is one lane. Changes wait until every lane has come ``slack``
    past them, but for lanes silent for ``idle_after`` batches; ``finish_changes`` applies those that wait when the feed has ended. A change
    that comes too late fails its batch, see ``frontier``. With ``snapshot``, chunks of the
    source are read between the batches. ``trigger=None`` takes what is available and stops.
    """
    if isinstance(store, VersionedStore):
        raise TypeError("changes are applied to a KeyedStore; a VersionedStore takes upserts")

    def commit(batch: DataFrame, number: int) -> None:
        feed = storage.feed_of(store.spark, checkpoint)
        if store.has(feed, number):
            return
        # Kept on disk, so the source is not fetched and decoded for every use.
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            ready, state = frontier.advance(batch, store, lanes, slack, expected_lanes, late, max_held, idle_after)
            within = snapshot.covered() if snapshot else None
            reduced = ops.reduce_changes(ready, store.keys, within=within, **options)
            part = snapshot.chunk(chunks_per_batch) if snapshot else None
            if part is None:
                store.commit(reduced, feed, number, lambda: state)
            else:
                rows, cursor = part
                store.commit(reduced.unionByName(rows), feed, number, lambda: {**state, **cursor()})
        finally:
            batch.unpersist()

    return _start(stream, commit, checkpoint, trigger)


def finish_changes(store: KeyedStore, **options) -> None:
    """Apply the changes that wait for a lane, as none will come any more."""
    waited = frontier.drain(store)
    if waited is not None:
        rows, state = waited
        store.commit(ops.reduce_changes(rows, store.keys, **options), state=lambda: state)


def start_upserts(
    stream: DataFrame,
    store: VersionedStore,
    checkpoint: str,
    trigger: str | None = "6 seconds",
    row: str = "row",
    seq: str = "seq",
    deletes: bool = False,
) -> StreamingQuery:
    """Upsert a stream of keyed rows; NULL rows delete when ``deletes`` is on.

    The write of the highest ``seq`` wins, in whatever order and batches writes arrive.
    """
    if not isinstance(store, VersionedStore):
        raise TypeError("a stream of upserts needs a VersionedStore, which orders writes by seq")

    def commit(batch: DataFrame, number: int) -> None:
        feed = storage.feed_of(store.spark, checkpoint)
        store.commit(ops.latest_versions(batch, store.keys, row, seq, deletes), feed, number)

    return _start(stream, commit, checkpoint, trigger)
