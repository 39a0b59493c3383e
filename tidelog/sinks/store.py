"""A keyed table kept as plain Parquet files that streaming jobs can change.

The table is a *base*, in hash buckets of the key, and a few *deltas*: changes reduced
to one row per key. A commit writes a delta, so its cost follows the batch and not the
table; readers merge the deltas in. When they grow past a share of the base they are
merged into it, rewriting only the buckets they touch; when there are merely many
of them they are combined into one.

Every step writes a new version folder and then publishes a manifest naming what is
current. Until then readers see the previous table, and a step that dies half-way
leaves only a folder the next attempt overwrites. The manifest also records the last
batch of every feed, so a replayed batch is a no-op.

With ``key_filters`` every rewritten bucket gets a Bloom filter of its keys, so that a reader who
looks for some keys reads only the buckets that may hold them (``read_matching``).

A ``VersionedStore`` also keeps the position of every row's last write, and the deletes,
so that writes may arrive in any order.

One writer at a time. Where a table format with ``MERGE INTO`` is available, this class
is the one thing to replace.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import storage
from tidelog.operators import apply
from tidelog.session import empty_frame

FEW_KEYS = 100_000

#: Bits of a key filter for each key, in blocks of 64; a key sets four bits of one block.
FILTER_BITS = 16


def _filter_bits(keys: Sequence[str], blocks: Column) -> list[Column]:
    """The block of a key in a filter of so many blocks, and the bits it sets there."""
    place = F.xxhash64(F.lit(7), *keys)
    bits = [F.expr(f"shiftleft(1L, cast(shiftright(h, {6 * i}) & 63 as int))") for i in range(4)]
    block = F.pmod(F.shiftright("h", 24), blocks)
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return [place.alias("h"), block.alias("block"), mask.alias("mask")]


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    buckets: dict[int, int] = field(default_factory=dict)
    base_rows: int = 0
    deltas: dict[int, int] = field(default_factory=dict)
    feeds: dict[str, int] = field(default_factory=dict)
    #: How the table is laid out; a store opened with another layout is refused.
    layout: dict[str, int | list[str]] = field(default_factory=dict)
    #: Order of a feed (``streaming.frontier``): the highest ``seq`` seen of every lane and the
    #: batch that last had some, up to where changes are applied, and the version that holds
    #: those which wait.
    lanes: dict[str, int] = field(default_factory=dict)
    lane_seen: dict[str, int] = field(default_factory=dict)
    applied: int | None = None
    held: int | None = None
    #: A snapshot under way (``streaming.snapshot``).
    snapshot: dict = field(default_factory=dict)
    #: The highest position written, and that up to which deletes may have been forgotten.
    last_seq: int | None = None
    horizon: int | None = None

    @property
    def delta_rows(self) -> int:
        return sum(self.deltas.values())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        spec = json.loads(text)
        for name in ("buckets", "deltas"):
            spec[name] = {int(k): v for k, v in spec[name].items()}
        return cls(**spec)


class KeyedStore:
    """``base/v=<version>/bucket=<b>``, ``delta/v=<version>`` and ``manifest/<version>.json``.

    Deltas are merged when they hold over ``min_merge_rows`` rows and over ``merge_share``
    of the base, and combined when there are over ``max_deltas``. Every ``keep_versions``
    commits, folders that no later manifest than the last so many names are deleted.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        merge_share: float = 0.1,
        min_merge_rows: int = FEW_KEYS,
        max_deltas: int = 64,
        keep_versions: int = 32,
        key_filters: bool = False,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets
        self.merge_share = merge_share
        self.min_merge_rows = min_merge_rows
        self.max_deltas = max_deltas
        self.keep_versions = max(keep_versions, 8)  # a batch makes three versions at most
        self.key_filters = key_filters
        self.base_schema = schema
        self.delta_schema = self._delta_schema(T.StructField("had_delete", T.BooleanType()))

    def _delta_schema(self, mark: T.StructField) -> T.StructType:
        keys = [self.schema[k] for k in self.keys]
        return T.StructType([*keys, mark, T.StructField("row", self.schema)])

    # What a delta means

    def _combine(self, deltas: DataFrame) -> DataFrame:
        """Deltas (with their version ``v``) as one."""
        return apply.combine_reduced(deltas, self.keys, "v")

    def _merge(self, base: DataFrame, changes: DataFrame, few: bool) -> DataFrame:
        return apply.merge_changes(base, changes, self.keys, few=few)

    def _visible(self, rows: DataFrame) -> DataFrame:
        """The rows of the table among those of the base."""
        return rows

    # Manifests

    def _versions(self) -> list[int]:
        names = storage.list_names(self.spark, f"{self.path}/manifest")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _manifest_file(self, version: int) -> str:
        return f"{self.path}/manifest/{version:012d}.json"

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            versions = self._versions()
            if not versions:
                return Manifest()
            version = versions[-1]
        found = Manifest.from_json(storage.read_text(self.spark, self._manifest_file(version)))
        if found.layout and found.layout != self._layout():
            raise ValueError(f"the table at {self.path} is laid out as {found.layout}")
        return found

    def _layout(self) -> dict[str, int | list[str]]:
        return {"buckets": self.buckets, "keys": self.keys, "columns": self.base_schema.names}

    def _publish(self, manifest: Manifest) -> Manifest:
        manifest = replace(manifest, layout=self._layout())
        storage.write_text(self.spark, self._manifest_file(manifest.version), manifest.to_json())
        return manifest

    # Files

    def _bucket(self):
        typed = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.hash(*typed), F.lit(self.buckets))

    def _base_paths(self, buckets: dict[int, int]) -> list[str]:
        return [f"{self.path}/base/v={v}/bucket={b}" for b, v in sorted(buckets.items())]

    def _base(self, buckets: dict[int, int]) -> DataFrame:
        if not buckets:
            return empty_frame(self.spark, self.base_schema)
        return self.spark.read.schema(self.base_schema).parquet(*self._base_paths(buckets))

    def _write_base(self, rows: DataFrame, version: int) -> set[int]:
        """Write rows as a version's bucket folders; returns the buckets that hold any."""
        folder = f"{self.path}/base/v={version}"
        bucketed = rows.withColumn("bucket", self._bucket())
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        names = storage.list_names(self.spark, folder)
        held = {int(n.split("=")[1]) for n in names if n.startswith("bucket=")}
        if self.key_filters and held:
            self._write_filters(held, version)
        return held

    # Key filters

    _FILTER = "bucket int, blocks long, block long, mask long"

    def _write_filters(self, buckets: Iterable[int], version: int) -> None:
        """Beside a version's buckets, a filter of the keys of each."""
        keys = self._base(dict.fromkeys(buckets, version)).select(*self.keys, self._bucket().alias("bucket"))
        sizes = keys.groupBy("bucket").agg(F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") * FILTER_BITS / 64).cast("long")
        sized = keys.join(F.broadcast(sizes), "bucket").withColumn("blocks", blocks)
        place, block, mask = _filter_bits(self.keys, F.col("blocks"))
        marked = sized.withColumn("h", place).select("bucket", "blocks", block, mask)
        built = marked.groupBy("bucket", "blocks", "block").agg(F.bit_or("mask").alias("mask"))
        built.write.mode("overwrite").parquet(f"{self.path}/filter/v={version}")

    def may_hold(self, keys: DataFrame, manifest: Manifest | None = None) -> set[int]:
        """The base buckets that may hold some of ``keys``; all of theirs, without filters."""
        manifest = self.manifest() if manifest is None else manifest
        typed = [F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]
        asked = keys.select(*typed).withColumn("bucket", self._bucket())
        hit = {r["bucket"] for r in asked.select("bucket").distinct().collect()} & set(manifest.buckets)
        if not hit or not self.key_filters:
            return hit
        versions = {manifest.buckets[b] for b in hit}
        current = F.array(*[F.lit(f"{b}/{manifest.buckets[b]}") for b in sorted(hit)])
        filters = None
        for v in sorted(versions):
            own = self.spark.read.schema(self._FILTER).parquet(f"{self.path}/filter/v={v}")
            own = own.where(F.array_contains(current, F.concat_ws("/", "bucket", F.lit(v))))
            filters = own if filters is None else filters.unionByName(own)
        sizes = filters.select("bucket", "blocks").distinct()
        place, block, mask = _filter_bits(self.keys, F.col("blocks"))
        probes = asked.join(F.broadcast(sizes), "bucket").withColumn("h", place)
        probes = probes.select("bucket", block, mask.alias("asked")).distinct()
        met = probes.join(filters, ["bucket", "block"])
        found = met.where(F.col("mask").bitwiseAND(F.col("asked")) == F.col("asked"))
        return {r["bucket"] for r in found.select("bucket").distinct().collect()}

    def _deltas(self, versions: Iterable[int]) -> DataFrame:
        folders = [f"{self.path}/delta/v={v}" for v in versions]
        schema = T.StructType([*self.delta_schema.fields, T.StructField("v", T.LongType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/delta")
        return reader.parquet(*folders)

    def _combined(self, manifest: Manifest) -> DataFrame:
        """All deltas as one; a key has at most one row in each."""
        rows = self._deltas(manifest.deltas)
        if len(manifest.deltas) == 1:
            return rows.drop("v")
        return self._combine(rows)

    # Reading

    def _read(self, manifest: Manifest) -> DataFrame:
        base = self._base(manifest.buckets)
        if not manifest.deltas:
            return self._visible(base)
        few = manifest.delta_rows <= FEW_KEYS
        return self._visible(self._merge(base, self._combined(manifest), few))

    def read(self) -> DataFrame:
        """The table as of the latest commit."""
        return self._read(self.manifest())

    def read_matching(self, keys: DataFrame, feed: str, batch: int) -> DataFrame:
        """Rows of the table before a feed's batch, those of ``keys`` among them.

        Of the base only buckets that may hold a key are read; the deltas, which are a bounded
        share of it, whole.
        """
        manifest = self._manifest_before(feed, batch)
        wanted = self.may_hold(keys, manifest)
        buckets = {b: v for b, v in manifest.buckets.items() if b in wanted}
        return self._read(replace(manifest, buckets=buckets))

    def read_before(self, feed: str, batch: int) -> DataFrame:
        """The table as it was before a feed's batch, whether or not that is committed."""
        return self._read(self._manifest_before(feed, batch))

    def _manifest_before(self, feed: str, batch: int) -> Manifest:
        manifest = self.manifest()
        while manifest.version > 0 and manifest.feeds.get(feed, -1) >= batch:
            earlier = [v for v in self._versions() if v < manifest.version]
            if not earlier and manifest.version > 1:
                raise ValueError(f"the table before batch {batch} of {feed} is no longer kept")
            manifest = self.manifest(earlier[-1]) if earlier else Manifest()
        return manifest

    # Rows that wait

    def write_held(self, rows: DataFrame, version: int) -> int:
        """Keep rows beside the table for a later commit; how many they are."""
        path = f"{self.path}/held/v={version}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).count()

    def read_held(self, schema: T.StructType | None = None) -> DataFrame | None:
        """The rows that wait, or None."""
        held = self.manifest().held
        if held is None:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/held/v={held}")

    # Writing

    def create(self, rows: DataFrame) -> None:
        """Start the table from ``rows``; does nothing if it exists."""
        if self._versions():
            return
        typed = self._as_base(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]))
        held = self._write_base(typed.repartition(self.buckets, *self.keys), 1)
        buckets = dict.fromkeys(held, 1)
        self._publish(Manifest(1, buckets, self._base(buckets).count()))

    def _as_base(self, rows: DataFrame) -> DataFrame:
        return rows

    def has(self, feed: str, batch: int) -> bool:
        """Whether a feed's batch is committed."""
        return self.manifest().feeds.get(feed, -1) >= batch

    def _admit(self, delta: DataFrame, current: Manifest) -> dict:
        """Check a delta that is written but not published; fields of the manifest it sets."""
        return {}

    def commit(
        self,
        reduced: DataFrame,
        feed: str | None = None,
        batch: int | None = None,
        state: Callable[[], dict] | None = None,
    ) -> None:
        """Add changes reduced to one row per key (the columns of ``delta_schema``).

        ``state`` gives more fields of the manifest to publish with them; it is called once
        the changes have been read and written.
        """
        current = self.manifest()
        if feed is not None and current.feeds.get(feed, -1) >= batch:
            return
        version = current.version + 1
        typed = reduced.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.delta_schema.fields]
        )
        typed.write.mode("overwrite").parquet(f"{self.path}/delta/v={version}")
        delta = self._deltas([version])
        rows = delta.count()
        deltas = {**current.deltas, version: rows} if rows else current.deltas
        feeds = current.feeds if feed is None else {**current.feeds, feed: batch}
        more = {**(self._admit(delta, current) if rows else {}), **(state() if state else {})}
        after = self._publish(replace(current, version=version, deltas=deltas, feeds=feeds, **more))
        self._tidy(after)
        if version % self.keep_versions == 0:
            self.vacuum(self.keep_versions)

    def _tidy(self, after: Manifest) -> None:
        if after.delta_rows > max(self.min_merge_rows, self.merge_share * after.base_rows):
            self.merge_deltas()
        elif len(after.deltas) > self.max_deltas:
            self.combine_deltas()

    def combine_deltas(self) -> None:
        """Replace the deltas by one."""
        current = self.manifest()
        if len(current.deltas) < 2:
            return
        version = current.version + 1
        folder = f"{self.path}/delta/v={version}"
        self._combined(current).write.mode("overwrite").parquet(folder)
        rows = self._deltas([version]).count()
        self._publish(replace(current, version=version, deltas={version: rows}))

    def merge_deltas(self) -> None:
        """Merge the deltas into the base, rewriting the buckets they touch."""
        current = self.manifest()
        if not current.deltas:
            return
        version = current.version + 1
        touched_rows = self._deltas(current.deltas).select(self._bucket().alias("bucket"))
        touched = {row["bucket"] for row in touched_rows.distinct().collect()}
        old = {b: v for b, v in current.buckets.items() if b in touched}
        target, changes = self._base(old), self._combined(current)
        few = current.delta_rows <= FEW_KEYS
        if few:
            # Gathered by bucket, the new rows add at most one file to each.
            changes = changes.repartition(self._bucket())
        else:
            # Both sides hashed alike and to the bucket count: the join needs no further
            # shuffle, and each bucket is written by one task.
            target = target.repartition(self.buckets, *self.keys)
            changes = changes.repartition(self.buckets, *self.keys)
        merged, more = self._forget(self._merge(target, changes, few), current)
        new = dict.fromkeys(self._write_base(merged, version), version)
        kept = {b: v for b, v in current.buckets.items() if b not in touched}
        # Counts come from file footers.
        base_rows = current.base_rows - self._base(old).count() + self._base(new).count()
        buckets = {**kept, **new}
        self._publish(
            replace(current, version=version, buckets=buckets, base_rows=base_rows, deltas={}, **more)
        )

    def _forget(self, rows: DataFrame, current: Manifest) -> tuple[DataFrame, dict]:
        """Rows worth keeping when buckets are rewritten; fields of the manifest that sets."""
        return rows, {}

    def vacuum(self, keep: int = 4) -> None:
        """Delete folders that none of the last ``keep`` manifests names."""
        versions = self._versions()
        kept = versions[-max(keep, 1):]
        manifests = [self.manifest(v) for v in kept]
        needed = {
            "base": {v for m in manifests for v in m.buckets.values()},
            "delta": {v for m in manifests for v in m.deltas},
            "held": {m.held for m in manifests},
        }
        needed["filter"] = needed["base"]
        for version in versions:
            if version not in kept:
                storage.delete_folder(self.spark, self._manifest_file(version))
        for kind, wanted in needed.items():
            for name in storage.list_names(self.spark, f"{self.path}/{kind}"):
                version = int(name.split("=")[1]) if name.startswith("v=") else None
                # A folder past the last manifest may belong to a step under way.
                if version is not None and version not in wanted and version <= versions[-1]:
                    storage.delete_folder(self.spark, f"{self.path}/{kind}/{name}")


class VersionedStore(KeyedStore):
    """A keyed table whose rows remember the position of their last write.

    Deltas hold key, ``seq`` and ``row`` (NULL deletes); per key the highest ``seq`` counts, in
    whatever order and batches writes arrive. A deleted key stays as a tombstone, unseen by
    readers. With ``retain``, a rewrite of a bucket forgets tombstones that lie so many
    positions behind the last; after that a write that old to a key the table lacks fails,
    as it might be older than a forgotten delete. The rows of ``create`` are older than any write.
    """

    BEFORE_ALL = -(1 << 63)

    def __init__(self, *args, retain: int | None = None, **options):
        super().__init__(*args, **options)
        self.retain = retain
        self.base_schema = T.StructType([*self.schema.fields, *apply.VERSION])
        self.delta_schema = self._delta_schema(T.StructField("seq", T.LongType()))

    def _combine(self, deltas: DataFrame) -> DataFrame:
        return apply.combine_versions(deltas, self.keys)

    def _merge(self, base: DataFrame, changes: DataFrame, few: bool) -> DataFrame:
        return apply.merge_versions(base, changes, self.keys, few=few)

    def _visible(self, rows: DataFrame) -> DataFrame:
        return rows.where("not _deleted").select(*self.schema.names)

    def _as_base(self, rows: DataFrame) -> DataFrame:
        marks = (F.lit(self.BEFORE_ALL), F.lit(False))
        return rows.select("*", *[m.alias(f.name) for m, f in zip(marks, apply.VERSION)])

    def _admit(self, delta: DataFrame, current: Manifest) -> dict:
        low, high = delta.agg(F.min("seq"), F.max("seq")).first()
        if current.horizon is not None and low <= current.horizon:
            known = self._base(current.buckets).select(*self.keys)
            if current.deltas:
                known = known.unionByName(self._deltas(current.deltas).select(*self.keys))
            old = delta.where(F.col("seq") <= current.horizon).join(known, self.keys, "left_anti")
            if not old.isEmpty():
                raise ValueError(
                    f"a write at or before {current.horizon}, up to where deletes were forgotten, "
                    "to a key that the table lacks"
                )
        return {"last_seq": high if current.last_seq is None else max(high, current.last_seq)}

    def _forget(self, rows: DataFrame, current: Manifest) -> tuple[DataFrame, dict]:
        if self.retain is None or current.last_seq is None:
            return rows, {}
        bound = current.last_seq - self.retain
        bound = bound if current.horizon is None else max(bound, current.horizon)
        kept = rows.where(~F.col("_deleted") | (F.col("_seq") > bound))
        return kept, {"horizon": bound}
