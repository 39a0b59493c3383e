"""A time-partitioned table whose partitions appear once they are complete.

Each micro-batch is staged in a folder of its own. A partition is published when event
time has passed its start by more than a delay: its rows are gathered from the batches
that staged some into the table, the catalog learns of it, a success file is written,
and the ledger says so. Every step overwrites its own output and the batch's marker
comes last, so a batch that failed half-way can run again, and one that is done is left
alone. Batches are numbered by the committer, in the order they come, whichever feed they
are of: a job on a new checkpoint adds to what earlier ones staged and published. Rows
arriving after their partition was published publish it again, whole, from a copy of what was
published, and the ledger marks it late. So what is staged for a partition is needed until
it is published, and folders that no open partition needs are deleted.

Several feeds may fill one table. Event time is then that of the feed furthest behind, so
nothing is published before every feed has passed it; a feed that has been silent for a
number of batches is idle and holds nothing back until it speaks again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog import storage
from tidelog.session import empty_frame
from tidelog.sinks import tables

PARTS = ("ts_date", "ts_hour", "ts_minute")
LEDGER = (
    "ts_date string, ts_hour string, ts_minute string, "
    "batches array<bigint>, top timestamp, published_in bigint, late boolean"
)


def partition_time(parts: Sequence[str] = PARTS) -> Column:
    """The start of a partition, from its date, hour and minute texts."""
    return F.to_timestamp(F.concat(*[F.col(p) for p in parts]), "yyyyMMddHHmm")


class PartitionCommitter:
    """Stages batches under ``path`` and publishes complete partitions of ``table``.

    The ledger has one row per partition, not per record: the batches that staged rows
    for it, its latest event time, and the batch that published it. A batch reads the
    ledger of the batch before it and writes its own.

    ``feeds`` names the feeds that are waited for, also before they send anything; without
    names all that comes is one feed. A feed counts as idle after ``idle_after`` batches of
    others (None: never). Feeds of one process take turns.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str,
        location: str,
        path: str,
        delay: str = "1 minute",
        feeds: Sequence[str] = (),
        idle_after: int | None = None,
    ):
        self.spark = spark
        self.table = table
        self.location = location.rstrip("/")
        self.path = path.rstrip("/")
        self.delay = delay
        self.feeds = tuple(feeds)
        self.idle_after = idle_after
        self._turn = Lock()

    def _clocks(self, before: int) -> dict[str, dict[str, int]]:
        """By feed its latest event time (microseconds) and the batch it last sent."""
        done = [n for n in self._done().values() if n < before]
        if not done:
            return {}
        return json.loads(storage.read_text(self.spark, f"{self.path}/clocks/{max(done)}.json"))

    def _clock(self, top: int | None, batch: int, feed: str) -> int | None:
        """Note what a batch of a feed brings, and tell the time of the feed furthest behind."""
        clocks = self._clocks(batch)
        tops = [x for x in (top, clocks.get(feed, {}).get("top")) if x is not None]
        clocks[feed] = {"top": max(tops, default=None), "batch": batch}
        file = f"{self.path}/clocks/{batch}.json"
        if storage.exists(self.spark, file):  # of an attempt that failed
            storage.delete_folder(self.spark, file)
        storage.write_text(self.spark, file, json.dumps(clocks))
        waited = []
        for name in self.feeds or clocks:
            own = clocks.get(name, {"top": None, "batch": -1})
            if self.idle_after is None or batch - own["batch"] <= self.idle_after:
                waited.append(own["top"])
        return None if None in waited else min(waited, default=None)

    def _done(self) -> dict[str, int]:
        """The finished batches, as ``feed.batch``, with the committer's number of each."""
        names = storage.list_names(self.spark, f"{self.path}/done")
        split = [name.partition(".") for name in names if name[0].isdigit()]
        return {batch: int(number) for number, _, batch in split}

    def ledger(self, before: int | None = None) -> DataFrame:
        """The ledger of the last finished batch, or of the last one below ``before``."""
        done = [n for n in self._done().values() if before is None or n < before]
        if not done:
            return empty_frame(self.spark, T.StructType.fromDDL(LEDGER))
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/batch={max(done)}")

    def _stage(self, rows: DataFrame, batch: int) -> T.StructType:
        for part in PARTS:
            no_part = F.raise_error(F.lit(f"a row without {part} belongs to no partition"))
            rows = rows.withColumn(part, F.coalesce(F.col(part), no_part.cast("string")))
        rows.write.mode("overwrite").parquet(f"{self.path}/stage/batch={batch}")
        return rows.schema

    def _staged(self, batches: Iterable[int], schema: T.StructType) -> DataFrame:
        folders = [f"{self.path}/stage/batch={n}" for n in batches]
        return self.spark.read.schema(schema).parquet(*folders)

    def _extend_ledger(self, arrived: DataFrame, batch: int, feed: str) -> DataFrame:
        """Write and return the batch's ledger: arrivals added, complete partitions marked."""
        parts = list(PARTS)
        joined = self.ledger(before=batch).join(arrived, parts, "full_outer")
        came = F.col("arrived_top").isNotNull()
        # what was published is in the table, and no longer looked for in the stage
        known = F.when(F.col("published_in").isNull(), F.col("batches"))
        known = F.coalesce(known, F.array().cast("array<bigint>"))
        merged = joined.select(
            *parts,
            F.when(came, F.concat(known, F.array(F.lit(batch).cast("bigint"))))
            .otherwise(known)
            .alias("batches"),
            F.greatest("top", "arrived_top").alias("top"),
            F.col("published_in"),
            F.col("late").alias("was_late"),
            came.alias("came"),
        )
        clock = self._clock(arrived.agg(F.max(F.unix_micros("arrived_top"))).first()[0], batch, feed)
        due = F.unix_micros(partition_time() + F.expr(f"interval {self.delay}"))
        complete = F.lit(False) if clock is None else due < F.lit(clock)
        # rows of a published partition publish it again, though an idle feed set time back
        publish = F.when(F.col("published_in").isNull(), complete).otherwise(F.col("came"))
        marked = merged.select(
            *parts,
            "batches",
            "top",
            F.when(publish, F.lit(batch).cast("bigint"))
            .otherwise(F.col("published_in"))
            .alias("published_in"),
            F.when(publish, F.col("published_in").isNotNull())
            .otherwise(F.col("was_late"))
            .alias("late"),
        )
        folder = f"{self.path}/ledger/batch={batch}"
        marked.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(LEDGER).parquet(folder)

    def process(
        self, rows: DataFrame, event_time: str, batch: int, checkpoint: str = "feed", feed: str | None = None
    ) -> None:
        """Stage a feed's batch, then publish what event time completes.

        ``checkpoint`` and ``batch`` tell a batch that comes again; ``feed`` is one of ``feeds``.
        """
        if self.feeds and feed not in self.feeds:
            raise ValueError(f"{feed} is none of the feeds {self.feeds}")
        with self._turn:
            self._process(rows, event_time, f"{checkpoint}.{batch}", feed or "")

    def _process(self, rows: DataFrame, event_time: str, name: str, feed: str) -> None:
        done = self._done()
        if name in done:
            return
        batch = max(done.values(), default=-1) + 1
        parts = list(PARTS)
        schema = self._stage(rows, batch)
        arrived = self._staged([batch], schema).groupBy(*parts).agg(
            F.max(event_time).alias("arrived_top")
        )
        ready = self._extend_ledger(arrived, batch, feed).where(F.col("published_in") == batch)
        columns = self._columns()
        new, late = ready.where("not late"), ready.where("late").select(*parts)
        sources = [r["n"] for r in new.select(F.explode("batches").alias("n")).distinct().collect()]
        pieces = []
        if sources:
            pieces.append(self._staged(sources, schema).join(new.select(*parts), parts, "left_semi"))
        if not late.isEmpty():
            # what was published has everything but this batch
            pieces.append(self._copied(late, batch))
            pieces.append(self._staged([batch], schema).join(late, parts, "left_semi"))
        if pieces:
            self._publish(reduce(DataFrame.unionByName, [p.select(*columns) for p in pieces]))
            # Names of the partitions this batch completed: catalog metadata, not rows.
            self._announce([tuple(row) for row in ready.select(*parts).toLocalIterator()])
        storage.touch(self.spark, f"{self.path}/done/{batch}.{name}")
        self._sweep(batch)

    def _columns(self) -> list[str]:
        return self.spark.table(self.table).columns

    def _copied(self, late: DataFrame, batch: int) -> DataFrame:
        """What the table holds of late partitions, copied before they are replaced.

        An attempt that failed after its copy was whole may have replaced them; then the copy counts.
        """
        folder = f"{self.path}/copies/batch={batch}"
        table = self.spark.table(self.table)
        if not storage.exists(self.spark, f"{folder}/_SUCCESS"):
            table.join(F.broadcast(late), list(PARTS), "left_semi").select(*table.columns).write.mode(
                "overwrite"
            ).parquet(folder)
        return self.spark.read.schema(table.schema).parquet(folder)

    def _sweep(self, batch: int) -> None:
        """Delete what no open partition, and no batch that may run again, needs."""
        open_ = self.ledger().where(F.col("published_in").isNull())
        needed = {r["n"] for r in open_.select(F.explode("batches").alias("n")).distinct().collect()}
        for kind, kept in (("stage", needed), ("copies", set()), ("ledger", {batch})):
            for name in storage.list_names(self.spark, f"{self.path}/{kind}"):
                number = int(name.split("=")[1])
                if number <= batch and number not in kept:
                    storage.delete_folder(self.spark, f"{self.path}/{kind}/{name}")
        for name in storage.list_names(self.spark, f"{self.path}/clocks"):
            if name.endswith(".json") and int(name[:-5]) < batch:
                storage.delete_folder(self.spark, f"{self.path}/clocks/{name}")

    def _publish(self, rows: DataFrame) -> None:
        """Replace the partitions ``rows`` belong to, and no others."""
        writer = tables.together(rows.select(*self._columns()), *PARTS).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS)
        writer.parquet(self.location)

    def _announce(self, partitions: Sequence[tuple[str, ...]], at_once: int = 200) -> None:
        """Write success files and add the partitions to the catalog."""

        def mark(values: tuple[str, ...]) -> None:
            folder = "/".join(f"{p}={v}" for p, v in zip(PARTS, values))
            storage.touch(self.spark, f"{self.location}/{folder}/_SUCCESS")

        with ThreadPoolExecutor(8) as pool:
            list(pool.map(mark, partitions))
        for start in range(0, len(partitions), at_once):
            specs = " ".join(
                "PARTITION (" + ", ".join(f"{p}='{v}'" for p, v in zip(PARTS, values)) + ")"
                for values in partitions[start : start + at_once]
            )
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {specs}")
        self.spark.catalog.refreshTable(self.table)

    def published(self) -> DataFrame:
        """The partitions readers may rely on."""
        known = self.ledger().where(F.col("published_in").isNotNull())
        return known.select(*PARTS, "published_in", "late")


def start_partition_commit(
    stream: DataFrame,
    committer: PartitionCommitter,
    event_time: str,
    checkpoint: str,
    trigger: str | None = "1 minute",
    feed: str | None = None,
) -> StreamingQuery:
    """Feed a stream, which carries the partition columns, to a committer.

    ``feed`` is its name where the committer waits for several.
    """

    def land(batch: DataFrame, number: int) -> None:
        own = storage.feed_of(committer.spark, checkpoint)
        committer.process(batch, event_time, number, own, feed)

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()
