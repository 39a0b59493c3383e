"""Inputs for queries, jobs and tests, derived from the given tables.

The SQL texts run unchanged in Spark and in DuckDB; ``{events}`` and ``{customer}``
stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import codecs
from tidelog.operators import skew

TOPIC = "demo"

DEMO_BASE = """
select cast(c_custkey * 2 as int) as id, c_name as actor, c_mktsegment as alias
from {customer}
"""

DEMO_CDC = """
select event_id as seq, ts, cast(user_id % 4 as int) as part,
  case event_type when 'signup' then 'c' when 'view' then 'r' when 'error' then 'd' else 'u' end as op,
  case when event_type in ('click', 'purchase', 'error') then cast(user_id as int) end as before_id,
  case when event_type = 'error' then null
       when event_id % 7 = 0 then cast(user_id + 1 as int)
       else cast(user_id as int) end as after_id,
  event_type as actor,
  case when event_id % 11 = 0 then null else props end as alias
from {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def demo_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DEMO_BASE, customer=table(spark, sf_dir, "customer"))


def demo_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DEMO_CDC, events=table(spark, sf_dir, "events"))


#: Rows of ``demo_timed`` live this many times faster, so that a month of events fills
#: half a day of minutes.
FASTER = 60


def demo_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only rows with a creation time, as text, and the event time."""
    zero = "timestamp_ntz'1970-01-01 00:00:00'"
    events = table(spark, sf_dir, "events").withColumn(
        "ts", F.expr(f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, {zero}, ts) div {FASTER}, {zero})")
    )
    return events.select(
        F.col("event_id").cast("int").alias("id"),
        F.col("event_type").alias("actor"),
        F.col("props").alias("alias"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def _image(key: str):
    image = F.struct(F.col(key).alias("id"), F.col("actor"), F.col("alias"))
    return F.when(F.col(key).isNotNull(), image)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as change envelopes: ``seq, ts, part, op, before, after``."""
    return demo_cdc(spark, sf_dir).select(
        "seq",
        F.col("ts").cast("timestamp").alias("ts"),
        "part",
        "op",
        _image("before_id").alias("before"),
        _image("after_id").alias("after"),
    )


def upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates and updates of the feed as plain keyed rows: ``seq, id, row``."""
    feed = demo_cdc(spark, sf_dir).where(F.col("op").isin("c", "u"))
    return feed.select("seq", F.col("after_id").alias("id"), _image("after_id").alias("row"))


def keyed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as keyed upserts with tombstones: ``seq, id, row``; deletes have a NULL row."""
    return demo_cdc(spark, sf_dir).select(
        "seq",
        F.coalesce("after_id", "before_id").alias("id"),
        _image("after_id").alias("row"),
    )


def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as transport records holding JSON envelopes, at position ``seq`` of its source."""
    return _as_records(changes(spark, sf_dir).withColumn("offset", F.col("seq")))


def dense_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``envelope_records``, with offsets counted from 0 in every partition."""
    numbered = skew.numbered(changes(spark, sf_dir), ("part",), "seq", "rank")
    return _as_records(numbered.withColumn("offset", F.col("rank") - 1))


def _as_records(feed: DataFrame) -> DataFrame:
    key = codecs.to_json(F.struct(F.coalesce("before.id", "after.id").alias("id")))
    value = codecs.to_json(F.struct("before", "after", "op"))
    return feed.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.col("part").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def gapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a broker may serve it: no record at every 50th offset, some delivered twice."""
    copies = F.sequence(F.lit(1), F.when(F.col("offset") % 10 == 0, 2).otherwise(1))
    records = dense_records(spark, sf_dir).withColumn("offset", F.expr("offset + offset div 49"))
    return records.withColumn("copy", F.explode(copies)).drop("copy")


def row_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates and updates as transport records holding a plain JSON row."""
    rows = upserts(spark, sf_dir)
    return rows.select("seq", codecs.to_json(F.col("row")).cast("binary").alias("value"))


def cut_points(feed: DataFrame, column: str, rounds: int) -> list[int]:
    """Bounds that cut a feed into ``rounds`` ranges of ``column``."""
    low, high = feed.agg(F.min(column), F.max(column)).first()
    step = (high - low) // rounds + 1
    return [low + step * i for i in range(rounds)] + [high + 1]
