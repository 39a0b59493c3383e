"""Feeds that are not there or not known: state differences, variant images, deep ranges, pacing."""

import time
from collections import Counter

import pytest
from folds import fold_changes
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_apply import BASE, CHANGES, as_table, base, frame, random_changes, row

from tidelog import schemas
from tidelog.functions import variants
from tidelog.operators import apply, diff
from tidelog.sources import feeds, jdbc
from tidelog.streaming.pacing import BatchLog, BatchTimeout, observed, paced

KEYS = ["id"]


# Two states


@pytest.mark.parametrize("buckets, ranges", [(1, 1), (4, 4), (1_024, 64)])
def test_applying_the_difference_gives_the_later_state(spark, buckets, ranges):
    later = fold_changes(BASE, [c[1:] for c in random_changes(3, n=80)])
    before, after = base(spark, BASE), base(spark, later)
    changes = diff.snapshot_changes(before, after, KEYS, 7, buckets, ranges)
    rows = changes.collect()
    want = {k for k in {*BASE, *later} if BASE.get(k) != later.get(k)}
    assert {(r.before or r.after).id for r in rows} == want and len(rows) == len(want)
    assert {r.op for r in rows} <= set("cud") and {r.seq for r in rows} == {7}
    assert as_table(apply.apply_changes(before, changes, KEYS)) == later


def test_equal_ranges_are_not_joined(spark):
    """One row of 4,000 differs: the join meets the rows of its range only."""
    before = spark.range(4_000).select(F.col("id").cast("int"), F.lit("a").alias("actor"), F.lit(None).cast("string").alias("alias"))
    after = before.withColumn("alias", F.when(F.col("id") == 17, F.lit("")))
    old, new = diff.unequal_ranges(before, after, KEYS, 64, 8)
    assert {17} <= {r.id for r in old.collect()} and old.count() < 40 and new.count() < 40
    assert diff.snapshot_changes(before, after, KEYS).count() == 1
    assert diff.snapshot_changes(before, before, KEYS).count() == 0
    assert [r.op for r in diff.snapshot_changes(before.where("id < 0"), before.where("id < 3"), KEYS).collect()] == ["c"] * 3


def test_swapped_values_and_null_keys(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "x")], schemas.DEMO)
    b = spark.createDataFrame([(1, None, "x"), (2, "x", None)], schemas.DEMO)
    assert diff.snapshot_changes(a, b, KEYS).count() == 2
    with pytest.raises(Exception, match="without its key"):
        diff.snapshot_changes(a, spark.createDataFrame([(None, "x", None)], schemas.DEMO), KEYS).collect()


# Variant images


def decoded(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return df.select(variants.variant_envelope(F.col("value")).alias("e")).select("e.*")


def test_schema_is_agreed_and_widened(spark):
    df = decoded(
        spark,
        '{"op":"c","before":null,"after":{"id":1,"price":2,"tag":"a","deep":{"x":1}}}',
        '{"op":"u","before":{"id":1,"price":2.5},"after":{"id":2,"tag":7,"at":"2024-01-01","od`d, k:ey":true}}',
        '{"op":"d","before":{"id":9007199254740993,"gone":null}}',
    )
    schema = variants.agreed_schema(df)
    kinds = {f.name: f.dataType for f in schema.fields}
    assert kinds["id"] == T.LongType() and kinds["price"] == T.DoubleType()
    assert kinds["tag"] == T.StringType() and kinds["deep"] == T.StringType()
    assert kinds["od`d, k:ey"] == T.BooleanType()
    typed = df.select("op", *[variants.typed_image(F.col(s), schema).alias(s) for s in ("before", "after")])
    rows = {r.op: r for r in typed.collect()}
    assert rows["c"].before is None and rows["c"].after.price == 2.0 and rows["c"].after.tag == "a"
    assert rows["c"].after.deep == '{"x":1}' and rows["u"].after.tag == "7" and rows["u"].before.price == 2.5
    assert rows["u"].after["od`d, k:ey"] is True and rows["d"].before.id == 9007199254740993
    assert rows["d"].after is None and rows["d"].before.gone is None


def test_bad_and_empty_feeds(spark):
    with pytest.raises(Exception):
        decoded(spark, '{"op":"c"').collect()
    empty = decoded(spark, '{"op":"t"}')
    assert empty.first().op == "t" and variants.agreed_schema(empty) == T.StructType([])
    with pytest.raises(ValueError, match="not objects"):
        variants.agreed_schema(decoded(spark, '{"op":"c","after":[1]}'))


# Ranges of equal depth


def test_no_split_holds_over_twice_the_mean(spark):
    """90 % of the keys lie in 1 % of their range; some are NULL, one comes often."""
    ids = [*range(900), *range(10_000, 90_000, 800), *[None] * 20, *[450] * 50]
    table = spark.createDataFrame([(i, f"a{n}", None) for n, i in enumerate(ids)], schemas.DEMO_WIDE)
    url = "jdbc:derby:memory:depth;create=true"
    jdbc.write_table(table, url, "deep")
    query = 'select "id", "actor", "alias" from deep'
    rows = jdbc.read_query(spark, url, query, schemas.DEMO_WIDE, split_by="id", splits=8, equal_depth=True)
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, table.collect()))
    sizes = [r.n for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * len(ids) / 8
    even = jdbc.read_query(spark, url, query, schemas.DEMO_WIDE, split_by="id", splits=8)
    assert max(r.n for r in even.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) > 800


# Pacing


def run(spark, folder, commit, name=None):
    schema = T.StructType.fromDDL(CHANGES)
    stream = feeds.file_feed(spark, f"{folder}/feed", schema, maxFilesPerTrigger="1")
    if name:
        stream = observed(stream, name, F.count("*").alias("rows"), F.max("seq").alias("top"))
    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", f"{folder}/cp")
    return writer.trigger(availableNow=True).start()


def feed(spark, folder, files=2):
    for i in range(files):
        part = [(10 * i + n, "c", None, row(n)) for n in range(3)]
        frame(spark, part, CHANGES).coalesce(1).write.mode("append").parquet(f"{folder}/feed")


def test_a_batch_beyond_its_time_stops_the_query(spark, folder):
    feed(spark, folder, 1)
    slow = F.udf(lambda x: time.sleep(30) or x, "long")
    began = time.monotonic()
    query = run(spark, folder, paced(lambda batch, n: batch.select(slow("seq")).collect(), timeout=2))
    with pytest.raises(Exception, match="batch 0 took over 2 s"):
        query.awaitTermination()
    assert time.monotonic() - began < 25
    # the batch comes again
    seen = []
    run(spark, folder, paced(lambda batch, n: seen.append((n, batch.count())), timeout=60)).awaitTermination()
    assert seen == [(0, 3)]


def test_batches_keep_apart_and_leave_metrics(spark, folder):
    feed(spark, folder, 3)
    log, times = BatchLog(), []
    spark.streams.addListener(log)
    try:
        def commit(batch, number):
            times.append(time.monotonic())
            batch.count()

        query = run(spark, folder, paced(commit, min_pause=1.5), "feed")
        query.awaitTermination()
        deadline = time.monotonic() + 20
        while str(query.id) not in log.reasons and time.monotonic() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert all(b - a >= 1.5 for a, b in zip(times, times[1:])) and len(times) == 3
    own = [b for b in log.batches if b[0] == str(query.id)]
    assert sorted(b[4]["feed"]["top"] for b in own) == [2, 12, 22] and {b[4]["feed"]["rows"] for b in own} == {3}
    assert log.reasons[str(query.id)] is None


def test_other_failures_are_told_as_they_are(spark, folder):
    def commit(batch, number):
        raise KeyError("something else")

    with pytest.raises(KeyError):
        paced(commit, timeout=5)(spark.range(1), 0)
    with pytest.raises(BatchTimeout):
        paced(lambda b, n: time.sleep(1.2), timeout=0.5)(spark.range(1), 0)
