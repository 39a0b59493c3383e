import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas
from tidelog.functions import codecs
from tidelog.sinks import script, tables
from tidelog.sources import feeds, files, jdbc


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_json_record(spark):
    good = lines(spark, '{"id":1,"actor":"a","extra":2}', "", None)
    got = good.select(codecs.json_record(F.col("value"), schemas.DEMO).alias("r")).collect()
    assert [r[0] and tuple(r[0]) for r in got] == [(1, "a", None), None, None]
    bad = lines(spark, '{"id":').select(codecs.json_record(F.col("value"), schemas.DEMO))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        bad.collect()


def test_envelope_round_trip(spark):
    text = '{"before":null,"after":{"id":1,"actor":null,"alias":"x"},"op":"c"}'
    df = lines(spark, text).select(codecs.envelope(F.col("value")).alias("e"))
    assert df.select(codecs.to_json(F.col("e"))).first()[0] == text


def test_delimited(spark):
    df = lines(spark, "1,a", "2,b,ignored", "3,")
    got = df.select(*codecs.delimited(F.col("value"))).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, "b"), (3, "")]


@pytest.mark.parametrize("bad", ["7", "x,a", ",a", "", " 1 ,a"])
def test_delimited_bad_line_fails(spark, bad):
    with pytest.raises(Exception, match="too few fields|blanks|CAST_INVALID_INPUT"):
        lines(spark, bad).select(*codecs.delimited(F.col("value"))).collect()


def test_typed_record(spark):
    record = schemas.from_avro_json(schemas.DEMO_AVRO_JSON)
    assert record == T.StructType(
        [T.StructField("id", T.LongType(), False)]
        + [T.StructField(c, T.StringType(), False) for c in ("actor", "alias")]
    )
    rows = spark.createDataFrame([(1, "a", None)], schemas.DEMO)
    with pytest.raises(Exception, match="required field alias"):
        codecs.typed_record(rows, record).collect()
    with pytest.raises(ValueError):
        schemas.from_avro_json('{"type": "record", "fields": [{"name": "x", "type": "map"}]}')


def test_text_line_prints_null(spark):
    rows = spark.createDataFrame([(1, None, "x")], schemas.DEMO)
    line = rows.select(codecs.text_line("Demo", schemas.COLUMNS)).first()[0]
    assert line == "Demo(id=1, actor=null, alias=x)"


def test_statements():
    text = """
      -- first; not a break
      SELECT 'a;b', "c;d", `e;f` /* g;h */ ;
      ; ;
      SELECT 'it''s' - 1 / 2; -- last
    """
    assert len(script.statements(text)) == 2
    assert script.statements("  ;\n; ") == []
    assert script.statements("select 1") == ["select 1"]


def test_script_stops_at_first_failure(spark):
    text = "CREATE OR REPLACE TEMP VIEW s1 AS SELECT 1 a; SELECT * FROM nowhere_at_all; SELECT 1"
    with pytest.raises(script.ScriptError, match="statement 2") as failure:
        script.run(spark, text)
    assert failure.value.number == 2
    assert spark.table("s1").count() == 1
    assert script.run(spark, "SELECT 1;;") == 1


def test_jdbc_partitioned_read_and_nulls(spark):
    url = "jdbc:derby:memory:codecs;create=true"
    rows = spark.createDataFrame([(i, f"n{i}", None) for i in range(100)], schemas.DEMO)
    jdbc.write_table(rows, url, "demo")
    query = 'select "id", "actor", "alias" from demo'
    read = jdbc.read_query(spark, url, query, schemas.DEMO_WIDE, split_by="id", splits=4)
    assert read.rdd.getNumPartitions() == 4
    assert read.schema == schemas.DEMO_WIDE and read.count() == 100
    none = jdbc.read_query(spark, url, query + ' where "id" < 0', schemas.DEMO, split_by="id")
    assert none.count() == 0
    record = jdbc.read_json(spark, url, query + ' where "id" = 7', schemas.DEMO).first()[0]
    assert record == '{"id":7,"actor":"n7","alias":null}'


def test_starting_offsets():
    assert feeds.starting_offsets("earliest") == "earliest"
    assert feeds.starting_offsets({"t": {0: 5, 1: 0}}) == '{"t": {"0": 5, "1": 0}}'
    with pytest.raises(ValueError):
        feeds.starting_offsets("middle")


def test_inline_rows_and_lengths(spark, folder):
    people = [("Alice", 1), ("Bob", 2), ("Charlie", 3)]
    df = files.inline_rows(spark, people, schemas.PERSON, "people_view")
    assert spark.sql("SELECT id, name FROM people_view ORDER BY id").collect()[2] == (3, "Charlie")
    df.write.parquet(f"{folder}/p")
    listed = files.file_lengths(spark, f"{folder}/p")
    assert listed.count() > 0 and "content" not in listed.columns
    scan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scan.split("ReadSchema")[-1]


def test_drop_partition_and_overwrite(spark, folder):
    schema = T.StructType.fromDDL("id int, day string")
    tables.create_table(spark, "days", schema, f"{folder}/days", ["day"])
    rows = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    tables.partitioned_insert(rows, "days", ["day"])
    tables.drop_partition(spark, "days", {"day": "a"})
    assert [tuple(r) for r in spark.table("days").collect()] == [(2, "b")]
