"""The order of a change feed across micro-batches.

Applying changes is only right in the order of ``seq``, and micro-batches need not come in
that order: a feed has *lanes* (topic and partition, say) that run ahead of each other, and
files arrive as they like. The frontier is the highest ``seq`` of the lane that is furthest
behind, less ``slack``: where lanes are ordered, every change up to it has arrived. Changes
up to the frontier are applied; those past it wait beside the table, for a later batch or
for the end of the feed. Lanes, frontier and what waits are published with the table, in
one manifest, so a crash loses none of them.

A change at or below the frontier is out of order and fails its batch (``OutOfOrder``), or,
with ``late="skip"``, is taken for one that was applied before: a feed read again from the
start by a new checkpoint. A lane that has been silent for ``idle_after`` batches is not waited
for; should it come back with a change below the frontier, that one is out of order. What waits
is bounded: beyond ``max_held`` rows the batch fails and names the lane that lags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.sinks.store import KeyedStore, Manifest

MAX_HELD = 100_000_000


class OutOfOrder(ValueError):
    """A batch that cannot be applied in order."""


def _lane(lanes: Sequence[str]):
    """The lane of a row, as text."""
    return F.to_json(F.struct(*lanes), {"ignoreNullFields": "false"}) if lanes else F.lit("{}")


def advance(
    batch: DataFrame,
    store: KeyedStore,
    lanes: Sequence[str] = (),
    slack: int = 0,
    expected: int | None = None,
    late: str = "fail",
    max_held: int = MAX_HELD,
    idle_after: int | None = None,
) -> tuple[DataFrame, dict]:
    """The changes to apply now, those that waited among them, and the manifest's new fields.

    ``expected`` is the number of lanes the feed has: until all have been seen nothing is
    applied, as a lane that is not known cannot be waited for.
    """
    if late not in ("fail", "skip"):
        raise ValueError("late changes 'fail' or 'skip'")
    manifest = store.manifest()
    seen = (
        batch.groupBy(_lane(lanes).alias("lane"))
        .agg(F.min("seq").alias("low"), F.max("seq").alias("high"), F.count_if(F.col("seq").isNull()).alias("none"))
        .collect()
    )
    tops, heard = dict(manifest.lanes), dict(manifest.lane_seen)
    turn = max(heard.values(), default=0) + 1
    for row in seen:
        if row["none"]:
            raise OutOfOrder(f"lane {row['lane']} has changes without seq")
        if late == "fail" and manifest.applied is not None and row["low"] <= manifest.applied:
            raise OutOfOrder(
                f"out of order: lane {row['lane']} delivers {row['low']}, and changes up to "
                f"{manifest.applied} are applied"
            )
        tops[row["lane"]] = max(row["high"], tops.get(row["lane"], row["high"]))
        heard[row["lane"]] = turn
    applied = manifest.applied
    if tops and (expected is None or len(tops) >= expected):
        waited_for = [x for lane, x in tops.items() if idle_after is None or turn - heard[lane] <= idle_after]
        level = min(waited_for or tops.values()) - slack
        applied = level if applied is None else max(applied, level)
    pending = batch if manifest.applied is None else batch.where(F.col("seq") > manifest.applied)
    waited = store.read_held(batch.schema)
    if waited is not None:
        pending = pending.unionByName(waited)
    rows, state = _split(pending, store, manifest, applied, tops, max_held)
    return rows, {**state, "lane_seen": heard}


def _split(
    pending: DataFrame, store: KeyedStore, manifest: Manifest, applied: int | None, tops: dict, max_held: int
) -> tuple[DataFrame, dict]:
    state = {"lanes": tops, "applied": applied, "held": None}
    if not tops or (applied is not None and max(tops.values()) <= applied):
        return pending, state
    waits = F.lit(True) if applied is None else F.col("seq") > applied
    version = manifest.version + 1
    count = store.write_held(pending.where(waits), version)
    if count > max_held:
        behind = min(tops, key=tops.get)
        raise OutOfOrder(f"{count} changes wait for lane {behind}, which has come to {tops[behind]}")
    return pending.where(~waits), {**state, "held": version if count else None}


def drain(store: KeyedStore) -> tuple[DataFrame, dict] | None:
    """What waits, to be applied as the feed has ended; None if nothing does."""
    waited = store.read_held()
    if waited is None:
        return None
    tops = store.manifest().lanes
    return waited, {"applied": max(tops.values()), "held": None}
