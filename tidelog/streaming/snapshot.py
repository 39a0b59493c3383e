"""Taking a snapshot of a table in chunks while its change feed runs.

The table is read by ranges of one key column, a chunk at a time, between the micro-batches of
its feed. Nothing is locked and the feed never waits: a chunk is read at whatever position the
table has come to, which lies between the *low* position (changes applied when the read began)
and the *high* one (asked of the table when the read has ended).

* Changes to keys beyond the cursor are left out; their chunk will hold them.
* Changes past the low position to keys of a chunk are applied to its rows. Those up to the high
  position may be in the rows already; for them a chunk's row gives way to what the feed says,
  and applying a change twice is applying it once: a deleted key has the first row after its
  last delete, and an insert finds its row there.
* So a chunk is exact once the feed has passed its high position, and the table is once the
  feed has passed the highest of them (``is_consistent``).

The cursor and the highest position are published with the rows, in one manifest. A job that
stops between two chunks, or in the middle of one, goes on with the chunk it had not published.
The plan of chunks is made once and kept beside the table.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import storage
from tidelog.sinks.store import KeyedStore

#: Chunks of a plan, however large the table; each is a distributed read.
MAX_CHUNKS = 10_000


@dataclass(frozen=True)
class SnapshotSource:
    """A table that changes while it is read.

    ``rows(condition)`` reads the rows now, where a condition on ``column`` holds (None: all).
    ``position()`` is the ``seq`` up to which changes of the feed are certainly in rows read
    before; it may be higher, never lower. ``column`` is the first key column, or another.
    """

    column: str
    rows: Callable[[Column | None], DataFrame]
    position: Callable[[], int]


def plan_chunks(source: SnapshotSource, chunk_rows: int) -> list:
    """Upper bounds of ranges of about ``chunk_rows`` rows, from quantiles of the column.

    The last range has no upper bound. Any bounds are right; these are near equal in rows,
    whatever the distribution of the values, unless one value has more.
    """
    column = source.rows(None).select(source.column)
    rows = column.count()
    chunks = min(MAX_CHUNKS, -(-rows // chunk_rows))
    if chunks < 2:
        return []
    steps = [i / chunks for i in range(1, chunks)]
    cuts = column.agg(F.percentile_approx(source.column, steps, 10 * chunks).alias("cuts")).first()["cuts"]
    return sorted(set(cuts))


def plan_of(store: KeyedStore, source: SnapshotSource, chunk_rows: int) -> list:
    """The plan kept beside the table; made at the first call."""
    path = f"{store.path}/snapshot-plan.json"
    if not storage.exists(store.spark, path):
        storage.write_text(store.spark, path, json.dumps(plan_chunks(source, chunk_rows), default=str))
    return json.loads(storage.read_text(store.spark, path))


@dataclass
class Snapshot:
    """A snapshot under way into a store."""

    store: KeyedStore
    source: SnapshotSource
    plan: list

    def _bound(self, chunk: int) -> Column:
        return F.lit(self.plan[chunk]).cast(self.store.schema[self.source.column].dataType)

    def _next(self) -> int:
        return self.store.manifest().snapshot.get("next", 0)

    @property
    def chunks(self) -> int:
        return len(self.plan) + 1

    def is_complete(self) -> bool:
        """Whether every chunk has been read."""
        return self._next() >= self.chunks

    def is_consistent(self) -> bool:
        """Whether the feed has also passed every chunk's high position."""
        manifest = self.store.manifest()
        high = manifest.snapshot.get("high")
        passed = high is None or (manifest.applied is not None and manifest.applied >= high)
        return self.is_complete() and passed

    def covered(self) -> Column | None:
        """The keys whose chunk has been read, as a condition; None for all."""
        done = self._next()
        if done >= self.chunks:
            return None
        return F.col(self.source.column) <= self._bound(done - 1) if done else F.lit(False)

    def chunk(self, n: int = 1) -> tuple[DataFrame, Callable[[], dict]] | None:
        """The next ``n`` chunks as reduced changes, and the cursor to publish with them.

        The cursor asks for the high position, so it is called when the rows have been read.
        """
        first = self._next()
        last = min(first + n, self.chunks)
        if first >= last:
            return None
        column, condition = F.col(self.source.column), F.lit(True)
        if first > 0:
            condition = condition & (column > self._bound(first - 1))
        if last < self.chunks:
            condition = condition & (column <= self._bound(last - 1))
        fields = self.store.schema.fields
        rows = self.source.rows(condition).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        reduced = rows.select(
            *self.store.keys, F.lit(False).alias("had_delete"), F.struct(*rows.columns).alias("row")
        )
        before = self.store.manifest().snapshot.get("high")

        def cursor() -> dict:
            high = self.source.position()
            return {"snapshot": {"next": last, "high": high if before is None else max(high, before)}}

        return reduced, cursor

    def finish(self, chunks_per_commit: int = 1) -> None:
        """Read the chunks that are left, where the feed is idle."""
        while (part := self.chunk(chunks_per_commit)) is not None:
            self.store.commit(part[0], state=part[1])
