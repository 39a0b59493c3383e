"""Plan shapes that must hold at any data size."""

import __spark_entry__ as entry_point
import pytest

from tidelog import fixtures as fx
from tidelog.operators import apply
from tidelog.sinks import script

BATCH = [
    "start_earliest",
    "start_after_offset",
    "start_initial",
    "kafka_json_decode",
    "upsert_kafka_table",
    "upsert_kafka_changelog",
    "envelope_decode",
    "delimited_lines",
    "op_name",
    "changelog_stream",
    "retract_stream",
    "changelog_flatten",
    "resequence",
    "upsert_kafka_encode",
    "cdc_apply",
    "insert_if_absent",
    "delete_by_key",
    "upsert_apply",
    "upsert_apply_deletes",
    "update_by_key",
    "append_only_guard",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_single_partition(spark, sf_dir, name):
    plan = plan_of(entry_point.queries()[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "SinglePartition", "PythonUDF"):
        assert unwanted not in plan


def test_apply_shuffles_each_side_once(spark, sf_dir):
    df = apply.apply_changes(fx.demo_base(spark, sf_dir), fx.changes(spark, sf_dir), ["id"])
    plan = final_plan(df)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Union" not in plan and "Broadcast" not in plan


def test_hot_keys_are_counted_once_and_combined_before_the_shuffle(spark, sf_dir):
    reduced = apply.reduce_changes(fx.changes(spark, sf_dir), ["id"], hot_rows=70)
    plan = final_plan(reduced)
    assert "ReusedExchange" in plan and "partial_min_by" in plan
    assert plan.count("Exchange hashpartitioning") == 4  # counts, their reuse, cold rows, hot rows


def test_upserts_combine_before_the_shuffle(spark, sf_dir):
    plan = plan_of(fx.upserts(spark, sf_dir).transform(
        lambda df: apply.latest_upserts(df, ["id"], "row", "seq")
    ))
    assert "partial_max_by" in plan


def test_columns_are_pruned(spark, sf_dir):
    plan = plan_of(entry_point.queries()["projection"](spark, sf_dir))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


def test_script_covers_ddl(spark):
    script.run(
        spark,
        """
        CREATE DATABASE IF NOT EXISTS ods;
        DROP TABLE IF EXISTS ods.demo;
        CREATE TABLE ods.demo (id BIGINT, actor STRING, alias STRING) USING parquet;
        INSERT INTO ods.demo VALUES (1, 'a;b', NULL);
        """,
    )
    assert [tuple(r) for r in spark.table("ods.demo").collect()] == [(1, "a;b", None)]
    script.run(spark, "DROP DATABASE ods CASCADE")
