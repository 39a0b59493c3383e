"""Putting a stream of transport records back in offset order, as set operations per batch."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog import storage
from tidelog.operators import sequence, skew

PARTS = ("topic", "partition")
OUTPUT = "topic string, partition int, offset bigint, value string, skipped bigint, late boolean"
RECORDS = "topic string, partition int, offset bigint, value string, arrival bigint"
MARKS = "topic string, partition int, next bigint, clock bigint"
STARTS = "topic string, partition int, start bigint"
GAPS = "topic string, partition int, low bigint, high bigint, given bigint"


def start_resequence(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    arrival: str = "arrival",
    max_wait: str = "1 minute",
    trigger: str | None = None,
    width: int = skew.SEGMENT,
    forget_after: str | None = None,
) -> StreamingQuery:
    """Land each (topic, partition, offset) once, holding records back until their turn.

    A record is released when all offsets before it have been, from 0 on, or when it has
    waited ``max_wait``; ``skipped`` counts the offsets given up just before it. A record
    that turns up after its offset was given up is released at once, marked ``late``.
    Copies of released records are dropped, and nothing else is.

    ``arrival`` is the time a record reached the log. Every partition has its own clock,
    the latest arrival it has seen, so one that lags behind others is not hurried.
    Records with a negative partition carry no value and move all clocks forward.
    A NULL position or arrival fails the batch.

    Offsets given up are kept as ranges; a late record leaves the rest of its range, one or
    two. With ``forget_after`` a range is dropped when its partition's clock has gone on by
    that much, and later records of it pass for copies; without, ranges stay until they fill.

    What is held back, one mark per partition and the ranges given up lie in the checkpoint
    folder by batch; a batch that runs again reads what its predecessor left and
    overwrites what it wrote. Marks are as many as the topics have partitions, so they pass
    through the driver. ``width`` only decides how a busy partition is split over tasks.
    """
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        feed = json.loads(storage.read_text(spark, f"{checkpoint}/metadata"))["id"]
        state = _State(spark, f"{checkpoint}/held", number)
        waits = _Waits(spark, max_wait, forget_after)
        _step(batch, state, arrival, waits, width, f"{path}/feed={feed}/batch={number}")
        state.forget()

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()


def released(spark: SparkSession, path: str) -> DataFrame:
    """The records landed under ``path``."""
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    return spark.read.schema(OUTPUT).parquet(path).select(*names)


class _Waits:
    """Spans of time in microseconds."""

    def __init__(self, spark: SparkSession, max_wait: str, forget_after: str | None):
        spans = [max_wait, forget_after or "0 seconds"]
        zero = "timestamp'1970-01-01 00:00:00'"
        asked = [f"unix_micros({zero} + interval {x}) - unix_micros({zero})" for x in spans]
        self.max_wait, forget = spark.sql(f"select {', '.join(asked)}").first()
        self.forget_after = forget if forget_after else None


class _State:
    """Tables of one batch, and those of the batch before."""

    def __init__(self, spark: SparkSession, path: str, number: int):
        self.spark, self.path, self.number = spark, path, number

    def before(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{self.number - 1}/{name}"
        if not storage.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{self.number}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def has_before(self, name: str) -> bool:
        return storage.exists(self.spark, f"{self.path}/{self.number - 1}/{name}")

    def marks_before(self) -> list[list]:
        if not self.has_before("marks.json"):
            return []
        return json.loads(storage.read_text(self.spark, f"{self.path}/{self.number - 1}/marks.json"))

    def put_marks(self, marks: list[list]) -> None:
        path = f"{self.path}/{self.number}/marks.json"
        if storage.exists(self.spark, path):  # of an attempt that failed
            storage.delete_folder(self.spark, path)
        storage.write_text(self.spark, path, json.dumps(marks))

    def drop(self, name: str) -> None:
        storage.delete_folder(self.spark, f"{self.path}/{self.number}/{name}")

    def forget(self) -> None:
        """Drop what no batch reads any more; this one and the one before may run again."""
        for name in storage.list_names(self.spark, self.path):
            if int(name) < self.number - 1:
                storage.delete_folder(self.spark, f"{self.path}/{name}")


def _given(column: str) -> Column:
    kind = {"topic": "string", "partition": "int", "offset": "bigint", "arrival": "bigint"}[column]
    failure = F.raise_error(F.lit(f"a record without its {column}")).cast(kind)
    return F.coalesce(F.col(column).cast(kind), failure).alias(column)


def _step(batch: DataFrame, state: _State, arrival: str, waits: _Waits, width: int, output: str) -> None:
    spark, parts = state.spark, list(PARTS)
    timed = batch.select(
        *PARTS, "offset", F.col("value").cast("string").alias("value"), F.unix_micros(arrival).alias("arrival")
    )
    named = timed.select(*(_given(c) for c in (*PARTS, "offset")), "value", _given("arrival"))
    came = state.put("came", sequence.distinct_records(named))

    # one mark per partition: the offset it waits for, and its clock
    marks = {(t, p): [n, c] for t, p, n, c in state.marks_before()}
    tick = None
    for topic, partition, top in came.groupBy(*PARTS).agg(F.max("arrival")).collect():
        if partition < 0:
            tick = top if tick is None else max(tick, top)
        else:
            own = marks.setdefault((topic, partition), [0, top])
            own[1] = max(own[1], top)
    for own in marks.values():
        own[1] = own[1] if tick is None else max(own[1], tick)
    now = spark.createDataFrame([(*key, *own) for key, own in marks.items()], MARKS)

    placed = came.where("partition >= 0").join(F.broadcast(now.select(*PARTS, "next")), parts)
    shown = [*PARTS, "offset", "value"]
    no_gap = F.lit(0).cast("bigint").alias("skipped")
    gaps, late = state.before("gaps", GAPS), None
    if state.has_before("gaps"):
        late = state.put("late", _late(placed.where("offset < next").select(*came.columns), gaps, width))

    rest = state.before("ranked", f"{RECORDS}, follows boolean").where("not follows").select(*came.columns)
    held = rest.unionByName(placed.where("offset >= next").select(*came.columns))
    held = state.put("pool", sequence.distinct_records(held))
    # everything up to the last record that has waited long enough goes ...
    due = held.join(F.broadcast(now), parts).where(F.col("arrival") <= F.col("clock") - waits.max_wait)
    waited = {(t, p): top + 1 for t, p, top in due.groupBy(*PARTS).agg(F.max("offset")).collect()}
    starts = [(*key, waited.get(key, own[0])) for key, own in marks.items()]
    turn = held.join(F.broadcast(spark.createDataFrame(starts, STARTS)), parts)
    # ... and so does what follows that, or the records released before, without a gap
    ranked = skew.numbered(turn.where("offset >= start"), PARTS, "offset", "rank", width)
    ranked = ranked.withColumn("follows", F.col("offset") - F.col("rank") == F.col("start") - 1)
    ranked = state.put("ranked", ranked.select(*came.columns, "follows"))
    turned = ranked.where("follows").select(*shown, no_gap)
    if waited:
        first = turn.where("offset < start").join(F.broadcast(now.select(*PARTS, "next")), parts)
        turned = turned.unionByName(_after_gaps(first, width).select(*shown, "skipped"))
    turned = turned.withColumn("late", F.lit(False))
    if late is not None:
        turned = turned.unionByName(late.select(*shown, no_gap, F.lit(True).alias("late")))
    turned.write.mode("overwrite").parquet(output)

    turned = spark.read.schema(turned.schema).parquet(output).where("not late")
    for topic, partition, end in turned.groupBy(*PARTS).agg(F.max("offset") + 1).collect():
        marks[topic, partition][0] = end
    state.put_marks([[*key, *own] for key, own in marks.items()])
    state.drop("gaps")  # of an attempt that failed
    if waited or late is not None:
        clock = now.select(*PARTS, F.col("clock").alias("given"))
        opened = turned.where("skipped > 0").join(F.broadcast(clock), parts).select(
            *PARTS, (F.col("offset") - F.col("skipped")).alias("low"), (F.col("offset") - 1).alias("high"), "given"
        )
        left = opened if late is None else _left_open(gaps, late).unionByName(opened)
        if waits.forget_after is not None:
            aged = left.join(F.broadcast(now.select(*PARTS, "clock")), parts)
            left = aged.where(F.col("given") >= F.col("clock") - waits.forget_after).drop("clock")
        state.put("gaps", left)


def _after_gaps(rows: DataFrame, width: int) -> DataFrame:
    """Adds ``skipped``, the offsets between a row and the one before, or ``next``.

    Only the last offset of each range of a partition crosses to the following range.
    """
    cut = rows.withColumn("seg", skew.segment("offset", width))
    lasts = cut.groupBy(*PARTS, "seg").agg(F.max("offset").alias("last"))
    in_turn = Window.partitionBy(*PARTS).orderBy("seg")
    carried = lasts.select(*PARTS, "seg", F.lag("last").over(in_turn).alias("carried"))
    inside = F.lag("offset").over(Window.partitionBy(*PARTS, "seg").orderBy("offset"))
    previous = F.coalesce("inside", "carried", F.col("next") - 1)
    return (
        cut.withColumn("inside", inside)
        .join(carried, [*PARTS, "seg"])
        .withColumn("skipped", F.col("offset") - previous - 1)
    )


def _late(records: DataFrame, gaps: DataFrame, width: int) -> DataFrame:
    """The records whose offset lies in a gap, with ``low``, ``high`` and ``given`` of the gap.

    Gaps are cut at the ends of ranges of ``width`` offsets and never overlap, so the gap
    of a record is the last one that begins before it in its range.
    """
    segs = F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"high div {width}"))).alias("seg")
    cut = gaps.select(*PARTS, "low", "high", "given", segs).select(
        *PARTS,
        "seg",
        F.greatest("low", F.col("seg") * width).alias("offset"),
        F.struct("low", "high", "given").alias("gap"),
    )
    own = records.withColumn("seg", skew.segment("offset", width))
    both = own.unionByName(cut, allowMissingColumns=True)
    # a gap stands before a record at its first offset
    order = Window.partitionBy(*PARTS, "seg").orderBy("offset", F.col("arrival").isNotNull())
    found = both.withColumn("gap", F.last("gap", ignorenulls=True).over(order))
    found = found.where("arrival is not null and offset <= gap.high")
    return found.select(*records.columns, "gap.low", "gap.high", "gap.given")


def _left_open(gaps: DataFrame, late: DataFrame) -> DataFrame:
    """The gaps without the offsets of the late records."""
    gap = [*PARTS, "low", "high", "given"]
    hit = late.select(*gap).distinct()
    before = F.lag("offset").over(Window.partitionBy(*gap).orderBy("offset"))
    pieces = late.withColumn("before", before).select(
        *PARTS, F.coalesce(F.col("before") + 1, "low").alias("low"), (F.col("offset") - 1).alias("high"), "given"
    )
    ends = late.groupBy(*gap).agg(F.max("offset").alias("last"))
    pieces = pieces.unionByName(ends.select(*PARTS, (F.col("last") + 1).alias("low"), "high", "given"))
    return gaps.join(hit, gap, "left_anti").unionByName(pieces.where("low <= high"))
