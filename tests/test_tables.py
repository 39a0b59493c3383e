"""Tables and jobs that add or drop only what they must."""

import pytest
from pyspark.sql import functions as F

from tidelog import schemas, storage
from tidelog.plans import jobs
from tidelog.sinks import files, tables
from tidelog.sources import feeds


def test_dropping_a_partition_frees_its_files(spark, folder):
    rows = spark.range(12).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("day"), (F.col("id") % 2).cast("string").alias("hour")
    )
    tables.create_table(spark, "dropping", rows.schema, f"{folder}/t", ["day", "hour"])
    tables.partitioned_insert(rows, "dropping", ["day", "hour"])
    assert storage.list_names(spark, f"{folder}/t/day=1") == ["hour=0", "hour=1"]
    tables.drop_partition(spark, "dropping", {"day": "1", "hour": "0"})
    assert storage.list_names(spark, f"{folder}/t/day=1") == ["hour=1"]
    # the first columns name several
    tables.drop_partition(spark, "dropping", {"day": "2"})
    assert storage.list_names(spark, f"{folder}/t/day=2") == []
    assert sorted(r.id for r in spark.table("dropping").collect()) == [0, 1, 3, 6, 7, 9]
    tables.drop_partition(spark, "dropping", {"day": "7"})
    # the same partition can come again
    tables.partitioned_insert(rows.where("day = '2'"), "dropping", ["day", "hour"])
    assert spark.table("dropping").count() == 10


def test_files_of_other_tables_stay(spark, folder):
    spark.sql(f"CREATE TABLE not_ours (id BIGINT, day STRING) USING parquet PARTITIONED BY (day) LOCATION '{folder}/o'")
    spark.sql("INSERT INTO not_ours VALUES (1, 'a'), (2, 'b')")
    tables.drop_partition(spark, "not_ours", {"day": "a"})
    assert [r.id for r in spark.table("not_ours").collect()] == [2]
    assert "day=a" in storage.list_names(spark, f"{folder}/o")


def test_lines_are_landed_once(spark, folder):
    tables.create_table(spark, "landed_lines", schemas.LINE, f"{folder}/t")

    def send(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")
        jobs.lines_to_table_job(feeds.line_feed(spark, f"{folder}/in"), "landed_lines", f"{folder}/t", f"{folder}/cp")
        return sorted(tuple(r) for r in spark.table("landed_lines").collect())

    assert send("1,a", "2,b") == [(1, "a"), (2, "b")]
    before = set(storage.list_names(spark, f"{folder}/t"))
    assert send("3,c,ignored") == [(1, "a"), (2, "b"), (3, "c")]
    assert before < set(storage.list_names(spark, f"{folder}/t"))
    assert send() == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(Exception):  # a short line fails its batch and lands nothing
        send("4")
    assert spark.table("landed_lines").count() == 3


def test_keyed_topic_goes_to_kafka(spark, folder, monkeypatch):
    """The connector is not here, so what the job would write is caught on its way."""
    caught = {}

    def start(upserts, servers, topic, checkpoint, trigger):
        caught.update(columns=upserts.columns, servers=servers, topic=topic, streaming=upserts.isStreaming)

    monkeypatch.setattr(files, "start_kafka", start)
    records = feeds.file_feed(spark, folder)
    jobs.keyed_topic_job(records, None, f"{folder}/cp", servers="broker:9092", topic="demo")
    assert caught == {"columns": ["key", "value", "offset"], "servers": "broker:9092", "topic": "demo", "streaming": True}
