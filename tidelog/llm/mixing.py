"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 48-bit hash of its id, its place on its source's line. A
source that is to give ``q`` whole passes and a rest takes each document ``q`` times, and
once more those below a threshold of the hash. Thresholds nest: a larger budget takes a
superset. They are found without sorting: word totals by source and the hash's first 12
bits form a histogram; the bucket in which the rest runs out is the boundary, and only
the documents in boundary buckets are counted again by the next 12 bits, four times in
all. The last boundary bucket is taken if that brings the total nearer to the target.

Totals and histograms combine before they shuffle, so a source with most of the rows
costs no task more than others; nothing is sorted, and only DataFrame functions run.

Sources are ordered by code point with NULL last and weigh ``weights`` in turn. Targets
share the corpus' total by weight; none exceeds ``cap`` times its source's size, and
what it cannot take is shared by the others by weight, until none is above. Documents
with one id go together. A NULL id has the hash of empty text. NULL texts have size 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
CAP = 3
LEVELS = 4
DIGITS = 3  # hexadecimal digits of a level: 4,096 buckets


def _place() -> Column:
    name = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.substring(name, 1, LEVELS * DIGITS)


def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        _place().alias("place"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from ``source, size``; one row per source.

    Sources reach their caps in the order of size by weight. With the first ``j`` of them
    at their caps, the others share what is left; the level that fits is the first where
    no further cap is exceeded.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    ranked = sizes.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    ranked = ranked.withColumn("most", F.col("source_size") * cap)
    every = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    ranked = ranked.select(
        "*",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("shared_by"),
    )
    fits = F.col("left") * F.col("weight") <= F.col("most") * F.col("shared_by")
    ranked = ranked.withColumn("fits", fits)
    # the first level that fits holds for its source and all after it
    first = F.max(F.when(F.col("fits"), F.struct("shared_by", "left"))).over(every)
    ranked = ranked.withColumn("level", first)
    capped = F.col("level").isNull() | (F.col("shared_by") > F.col("level.shared_by"))
    share = F.col("weight") * F.col("level.left") / F.col("level.shared_by")
    target = F.when(capped, F.col("most").cast("double")).otherwise(share.cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """What to take of each source: whole passes, and the places of one more.

    ``of, source_size, target, passes, rest, edge, closed``; one row per source.
    """
    # one row per source
    plan = stored(targets(sized, weights, cap), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("passes", whole.cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    plan = plan.withColumn("of", F.col("source")).drop("source")
    same = F.col("source").eqNullSafe(F.col("of"))

    # the boundary of a source so far: the digits of its place and the words below it
    edge = plan.select("of", "rest", F.lit("").alias("edge"), F.lit(0).cast("long").alias("below"))
    for level in range(1, LEVELS + 1):
        digits = level * DIGITS
        near = sized.join(edge, same & F.col("place").startswith(F.col("edge")))
        bucket = F.substring("place", 1, digits)
        counts = near.groupBy("of", "rest", "below", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        line = Window.partitionBy("of").orderBy("bucket")
        counts = counts.withColumn("upto", F.col("below") + F.sum("words").over(line))
        counts = counts.where(F.col("upto") >= F.col("rest")).withColumn("under", F.col("upto") - F.col("words"))
        found = counts.groupBy("of", "rest").agg(F.min_by(F.struct("bucket", "under", "words"), "bucket").alias("at"))
        edge = stored(
            found.select("of", "rest", F.col("at.bucket").alias("edge"), F.col("at.under").alias("below"), "at.words"),
            "boundary",
        )
        if level < LEVELS:
            edge = edge.drop("words")

    # the whole last bucket goes in if that is nearer to the target
    nearer = F.col("below") + F.col("words") / 2 <= F.col("rest")
    last = edge.select(F.col("of").alias("edge_of"), "edge", nearer.alias("closed"))
    plan = plan.join(last, F.col("of").eqNullSafe(F.col("edge_of")), "left")
    return stored(plan.drop("edge_of"), "thresholds")


def with_copies(rows: DataFrame, plan: DataFrame, cap: int = CAP) -> DataFrame:
    """``rows`` with ``place`` and ``source``, and the ``plan`` and ``copies`` of each."""
    below = (F.col("place") < F.col("edge")) | (F.col("closed") & (F.col("place") == F.col("edge")))
    more = F.when((F.col("rest") > 0) & (F.col("passes") < cap) & below, 1).otherwise(0)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("copies", (F.col("passes") + more).cast("int"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``: one row per row."""
    sized = stored(_sized(docs), "sized")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    out = ["doc_id", "source", "size", "source_size", "target", "copies", taken]
    return with_copies(sized, thresholds(sized, weights, cap), cap).select(*out)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows that the mix takes, with all their columns and ``copies``, 1 to ``cap``.

    ``copies`` replaces a column of that name. Texts are not shuffled.
    """
    docs = docs.drop("copies")
    plan = thresholds(stored(_sized(docs), "sized"), weights, cap)
    own = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    placed = docs.select(own, F.col("source").cast("string").alias("source"), _place().alias("place"))
    return with_copies(placed, plan, cap).where("copies > 0").select("row.*", "copies")
