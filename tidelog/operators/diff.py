"""A change feed from two states of a table, where no feed was kept.

Rows are not compared one by one. Each state gives a digest per bucket of its keys (a count, a
sum and an exclusive-or of row hashes, combined before the shuffle); buckets with equal digests
are equal and go no further. Those left are cut into ranges of a second hash, and digested
again; only rows of unequal ranges meet in a join. So two states of a large table that differ
in a few rows cost two scans and little more. Two different ranges have equal digests with a
chance near 2^-128.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets, and ranges of each: what is collected or broadcast is at most their product.
BUCKETS, RANGES = 1_024, 64


def _digests(rows: DataFrame, *parts: str) -> DataFrame:
    columns = sorted(c for c in rows.columns if c not in ("_bucket", "_range"))
    # a NULL would leave a hash as it is, so whether a value is there is hashed as well
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    one, other = F.xxhash64(*values), F.xxhash64(F.lit(1), *values)
    return rows.groupBy(*parts).agg(
        F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.sum(F.pmod(other, F.lit(1 << 40))).alias("s")
    )


def _unequal(before: DataFrame, after: DataFrame, *parts: str) -> DataFrame:
    sides = [_digests(df, *parts).select(*parts, F.struct("n", "x", "s").alias(name)) for df, name in ((before, "a"), (after, "b"))]
    both = sides[0].join(sides[1], list(parts), "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(*parts)


def _given(keys: Sequence[str]) -> Column:
    no_key = F.raise_error(F.lit("a row without its key cannot be compared"))
    return F.when(F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x), F.lit(True)).otherwise(no_key.cast("boolean"))


def unequal_ranges(
    before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, ranges: int = RANGES
) -> tuple[DataFrame, DataFrame]:
    """The rows of both states whose key ranges differ, with ``_bucket`` and ``_range``."""

    def placed(df: DataFrame) -> DataFrame:
        typed = [F.col(k).cast(before.schema[k].dataType) for k in keys]
        place = F.xxhash64(*typed)
        bucket = F.pmod(place, F.lit(buckets)).cast("int")
        within = F.pmod(F.shiftright(place, 32), F.lit(ranges)).cast("int")
        return df.where(_given(keys)).select("*", bucket.alias("_bucket"), within.alias("_range"))

    sides = placed(before), placed(after)
    wanted = [r["_bucket"] for r in _unequal(*sides, "_bucket").collect()]
    # a literal list, which a source laid out by this bucket would not read past
    sides = tuple(df.where(F.col("_bucket").isin(wanted)) if wanted else df.where(F.lit(False)) for df in sides)
    pairs = F.broadcast(_unequal(*sides, "_bucket", "_range"))
    return tuple(df.join(pairs, ["_bucket", "_range"], "left_semi") for df in sides)


def snapshot_changes(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    seq: int = 0,
    buckets: int = BUCKETS,
    ranges: int = RANGES,
) -> DataFrame:
    """What turns one state into the other: ``seq, op, before, after``.

    Keys that came are creates, keys that went deletes, rows that differ updates. All carry
    the position ``seq``: each key has one change, so they need no order among themselves.
    Keys are unique and not NULL in both states; columns are those of ``before``.
    """
    keys, columns = list(keys), before.columns
    after = after.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in before.schema.fields])
    old, new = unequal_ranges(before, after, keys, buckets, ranges)
    old = old.select(*keys, F.struct(*columns).alias("before"))
    new = new.select(*keys, F.struct(*columns).alias("after"))
    both = old.join(new, keys, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
    op = F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d").otherwise("u")
    return both.select(F.lit(seq).cast("long").alias("seq"), op.alias("op"), "before", "after")
